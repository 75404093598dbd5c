"""Filling fixed-capacity containers with items of varying length.

Method: space-filling-curve order. A document's tokens are hashed into a vector of BUCKETS counts, projected to DIMS
dimensions, and its place on a Hilbert curve is its key. Exact counts of the curve's cells (prefixes of the key) cut it into
stretches of about STRETCH documents, whatever the number of partitions; each stretch is sorted by (key, id) and packed by
itself: best fit, longest first, all its containers being open to the end. A cell with more documents than a stretch is
dealt out to several by a hash of the id. Only items longer than a container are split: into full containers and a rest.

Defined cases: null and empty texts have length 0 and are put at the end of some container; equal texts have equal keys
and are ordered by id; repeated ids are packed each; texts of any length are handled in full; an empty table gives an
empty result; the capacity is at least 1. Container ids are unique, not consecutive, and the same on every run over the same
rows, however they are partitioned.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm.tokens import TOKENIZERS, VOCABULARY, encoder
from quillmark.runtime import staged

BUCKETS, DIMS, BITS = 256, 4, 12
#: Documents of a stretch of the curve, which is packed at once: the unit of work and the bound of a task's memory.
STRETCH = 8192
#: Leading bits of a key that name a cell; the table of cells, at most 2 ** CELL_BITS rows, goes to the driver and is broadcast (1 MB).
CELL_BITS = 15
_PROJECTION = np.random.default_rng(9).standard_normal((BUCKETS, DIMS)) / np.sqrt(BUCKETS)


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Index on the Hilbert curve of integer points (n, dims), each coordinate of so many bits (transpose form of Skilling)."""
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(dims):
            high = (x[i] & q) > 0
            t = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ t)
            if i:
                x[i] ^= t
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[dims - 1] & q) > 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def curve_key(ids: list[list[int]]) -> np.ndarray:
    """Place on the curve of each list of token ids."""
    v = np.zeros((len(ids), BUCKETS))
    for k, x in enumerate(ids):
        if x:
            h = (np.asarray(x, dtype=np.int64) * 2654435761 >> 13) % BUCKETS
            v[k] = np.log1p(np.bincount(h, minlength=BUCKETS))
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    p = (v / np.where(norm == 0, 1, norm)) @ _PROJECTION
    # Projections of unit vectors spread by about 1 / sqrt(BUCKETS).
    scaled = np.clip(p * np.sqrt(BUCKETS) / 6 + 0.5, 0, 1 - 1e-9)
    return hilbert((scaled * (1 << BITS)).astype(np.int64))


def pack_stretch(items: list[tuple[int, object]], capacity: int) -> list[tuple[object, int, int, int, int, int]]:
    """Best fit, longest first, of items (length, id): (id, piece, start, length, container, offset)."""
    out: list[tuple[object, int, int, int, int, int]] = []
    rest, count = [], 0
    for size, i in items:
        start = piece = 0
        while size - start > capacity:
            out.append((i, piece, start, capacity, count, 0))
            start, piece, count = start + capacity, piece + 1, count + 1
        rest.append((size - start, start, piece, i))
    rest.sort(key=lambda r: -r[0])  # stable: neighbours on the curve stay neighbours
    rooms: list[tuple[int, int]] = []  # (room, container), ascending
    for size, start, piece, i in rest:
        k = bisect.bisect_left(rooms, (size, -1))
        if k < len(rooms):
            room, c = rooms.pop(k)
        else:
            room, c, count = capacity, count, count + 1
        out.append((i, piece, start, size, c, capacity - room))
        bisect.insort(rooms, (room - size, c))
    return out


def _sizes(path: str):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        e = encoder(path)
        for s in batches:
            ids = e.encode(s)
            yield pd.DataFrame({"size": [len(x) for x in ids], "key": curve_key(ids)})

    return F.pandas_udf(run, "size long, key long")


def _packed(capacity: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["key", "id", "size"], kind="stable")
        rows = pack_stretch(list(zip(pdf["size"].tolist(), pdf["id"].tolist(), strict=True)), capacity)
        df = pd.DataFrame(rows, columns=["id", "piece", "start", "length", "container", "offset"])
        df["container"] += int(pdf["stretch"].iloc[0]) << 32
        return df

    return run


def stretches(cells: list[tuple[int, int]], target: int) -> list[tuple[int, int, int]]:
    """(cell, first stretch, number of stretches) of cells (cell, documents) in order along the curve."""
    out, stretch, held = [], 0, 0
    for cell, n in sorted(cells):
        if n > target:  # a dense cell has stretches of its own
            stretch, parts = stretch + (held > 0), -(-n // target)
            out.append((cell, stretch, parts))
            stretch, held = stretch + parts, 0
            continue
        if held + n > target:
            stretch, held = stretch + 1, 0
        out.append((cell, stretch, 1))
        held += n
    return out


def pack(df: DataFrame, id_col: str, text: str, capacity: int = 2048, path: str = f"{TOKENIZERS}/{VOCABULARY}", stretch: int = STRETCH) -> DataFrame:
    """(id, piece, start, length, container, offset): where tokens [start, start + length) of each document lie."""
    kind = dict(df.dtypes)[id_col]
    sized = df.select(df[id_col].alias("id"), _sizes(path)(F.coalesce(df[text], F.lit(""))).alias("s")).select("id", "s.size", "s.key")
    sized = sized.withColumn("cell", F.shiftright("key", DIMS * BITS - CELL_BITS).cast("int"))
    sized = staged(sized, "sizes")  # texts are encoded once
    cells = [tuple(r) for r in sized.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()]
    total = sum(n for _, n in cells)
    target = max(1, -(-total // max(1, -(-total // stretch))))  # stretches of about one size
    where = df.sparkSession.createDataFrame(stretches(cells, target) or [(0, 0, 1)], "cell int, first long, parts int")
    placed = sized.join(F.broadcast(where), "cell").withColumn("stretch", F.col("first") + F.pmod(F.xxhash64("id", "key"), F.col("parts")))
    schema = f"id {kind}, piece int, start long, length long, container long, offset long"
    out = placed.select("stretch", "key", "id", "size").groupBy("stretch").applyInPandas(_packed(capacity), schema)
    return out.withColumnRenamed("id", id_col)


def fill(packed: DataFrame, capacity: int) -> DataFrame:
    """(containers, tokens, room_left, fill): how full the containers are."""
    n = F.countDistinct("container")
    used = F.sum("length")
    return packed.agg(n.alias("containers"), used.alias("tokens"), (n * capacity - used).alias("room_left"), (used / (n * capacity)).alias("fill"))

"""Linear support vector machines of many splits of one table, fitted side by side over bags of word pairs.

The model, its steps and its limits are those of the pipeline in models.train_classifier (MLlib's LinearSVC: hinge loss, standardised
features, a free intercept, orthant-wise quasi-Newton steps without an L1 part). There each split counts, encodes and fits by itself;
here pairs are counted and encoded once for all splits, and a round of the fits is one job that reads the bags once for as many splits as
the driver can hold results of, all ten up to some 140,000 pairs on six cores.
"""

from __future__ import annotations

import math
from collections.abc import Generator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.operators.models import VOCABULARY, in_training, labelled
from quillmark.runtime import staged

#: Of the fit, as in models.train_classifier; the tolerance and the number of remembered steps are MLlib's.
REGULAR, ROUNDS, TOLERANCE, MEMORY = 1e-3, 40, 1e-6, 10
#: Words and texts of a block, unless one text is longer; blocks of a task are read one after the other.
BLOCK_WORDS, BLOCK_TEXTS = 1 << 18, 1 << 15
#: Results of so many tasks are added up by the driver; those of more tasks are first added up among themselves.
DIRECT = 16
#: Bytes that the tasks of a round send to the driver at most; splits beyond that are fitted after the others, one at least at a time.
SENT = 1 << 26

_BLOCK = "ids binary, starts binary, rows binary, texts binary, columns binary, column_starts binary, words binary, good binary, train binary, moments array<bigint>"


def _bags(df: DataFrame, key: str, content: str, label: str, seeds: list[int], good: str) -> DataFrame:
    """(words, good, train): bit i of train says that the row is in the training part of the i-th seed."""
    train = sum((F.when(in_training(key, s), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint") for i, s in enumerate(seeds)), F.lit(0).cast("bigint"))
    words = F.filter(F.split(F.lower(F.trim(F.col(content))), r"\s+"), lambda w: w != "")
    return labelled(df, content, label).select(words.alias("words"), (F.col(label) == good).alias("good"), train.alias("train"))


def _pairs_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words of each text; the text of each word pair, and the pairs; a text of under two words has the empty pair, as in models.features."""
    words = batch.column("words")
    size, flat = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64), words.flatten().cast(pa.string())
    text, short = np.repeat(np.arange(len(size)), size), np.flatnonzero(size < 2)
    within = text[1:] == text[:-1]
    pairs = pc.binary_join_element_wise(flat[:-1], flat[1:], " ").filter(pa.array(within)) if len(flat) > 1 else flat[:0]
    return size, np.append(text[:-1][within], short), pa.concat_arrays([pairs, pa.array([""] * len(short), pa.string())])


def _bits(train: np.ndarray, k: int) -> np.ndarray:
    return ((train >> np.arange(k, dtype=np.int64)[:, None]) & 1).astype(np.float64)


def _distinct(a: np.ndarray) -> np.ndarray:
    a = np.sort(a)
    return a[np.r_[True, a[1:] != a[:-1]]] if len(a) else a


def _first(a: np.ndarray) -> np.ndarray:
    """Where the runs of equal values begin."""
    return np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else np.zeros(0, np.int64)


def _count(k: int):
    def run(batches):
        for batch in batches:
            _, text, pairs = _pairs_of(batch)
            if not len(pairs):
                continue
            coded = pairs.dictionary_encode()
            code, bits = coded.indices.to_numpy().astype(np.int64), _bits(batch.column("train").to_numpy(), k)
            once = _distinct(code * batch.num_rows + text)
            of, at = once // batch.num_rows, once % batch.num_rows
            n = [np.bincount(code, b[text], len(coded.dictionary)).astype(np.int64) for b in bits]
            d = [np.bincount(of, b[at], len(coded.dictionary)).astype(np.int64) for b in bits]
            yield pa.RecordBatch.from_arrays([coded.dictionary, *map(pa.array, n + d)], names=["pair", *[f"n{i}" for i in range(k)], *[f"d{i}" for i in range(k)]])

    return run


def vocabulary(bags: DataFrame, k: int, most: int = VOCABULARY) -> pa.Table:
    """(pair, member, d0, d1, ...) for every pair that some split's model knows: those in two of its training texts at least, and of more
    than `most` of these the most frequent ones, ties by the pair. Bit i of member stands for the i-th split, d for its training texts."""
    d, n = [f"d{i}" for i in range(k)], [f"n{i}" for i in range(k)]
    counts = bags.mapInArrow(_count(k), "pair string, " + ", ".join(f"{c} bigint" for c in n + d)).groupBy("pair").agg(*[F.sum(c).alias(c) for c in n + d])
    counts = staged(counts.filter(F.greatest(*d, F.lit(0)) >= 2), "pairs")
    sizes = counts.agg(*[F.count_if(F.col(c) >= 2).alias(c) for c in d]).first()
    if max(sizes) <= most:
        member = sum((F.when(F.col(c) >= 2, F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint") for i, c in enumerate(d)), F.lit(0).cast("bigint"))
        kept = counts.withColumn("member", member)
    else:
        best = [counts.filter(F.col(d[i]) >= 2).orderBy(F.desc(n[i]), "pair").limit(most).select("pair", F.lit(1 << i).cast("bigint").alias("bit")) for i in range(k)]
        every = best[0]
        for b in best[1:]:
            every = every.unionByName(b)
        kept = counts.join(every.groupBy("pair").agg(F.sum("bit").alias("member")), "pair")
    # The most frequent first, so that most of what a bag looks up lies close together.
    return kept.orderBy(F.desc(sum((F.col(c) for c in d), F.lit(0))), "pair").select("pair", "member", *d).toArrow()


def _encode(k: int, known):
    """Blocks of texts: the ids of each text's distinct pairs, row by row and column by column; word counts; moments of these by split."""

    def run(batches):
        names = known.value
        v = max(len(names), 1)
        for batch in batches:
            size, text, pairs = _pairs_of(batch)
            ids = pc.fill_null(pc.index_in(pairs, value_set=names), -1).to_numpy().astype(np.int64)
            once = _distinct(text[ids >= 0] * v + ids[ids >= 0])
            text, ids = once // v, once % v
            good, train = batch.column("good").to_numpy(zero_copy_only=False).astype(bool), batch.column("train").to_numpy()
            ends, a, rows = np.cumsum(size), 0, []
            while a < len(size):
                b = int(np.searchsorted(ends, (ends[a - 1] if a else 0) + BLOCK_WORDS, "right"))
                b = min(max(b, a + 1), a + BLOCK_TEXTS)
                lo, hi = np.searchsorted(text, (a, b))
                t, c, w, bits = text[lo:hi] - a, ids[lo:hi], size[a:b], _bits(train[a:b], k).astype(np.int64)
                across = np.sort((c << 16) | t)
                at, by = _first(t), _first(across >> 16)
                arrays = (c.astype(np.int32), at.astype(np.int32), t[at].astype(np.int32), (across & 0xFFFF).astype(np.uint16), (across[by] >> 16).astype(np.int32), by.astype(np.int32), w.astype(np.float64), good[a:b], train[a:b])
                rows.append([x.tobytes() for x in arrays] + [np.concatenate([bits.sum(1), bits @ w, bits @ (w * w)]).tolist()])
                a = b
            kinds = [pa.binary()] * 9 + [pa.list_(pa.int64())]
            for r in rows:
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(r, kinds)], names=[x.split()[0] for x in _BLOCK.split(", ")])

    return run


def _read(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            col = lambda name, kind: np.frombuffer(batch.column(name)[i].as_buffer(), kind)  # noqa: B023, E731
            texts = lambda: col("texts", np.uint16).astype(np.int64)  # noqa: B023, E731
            yield col("ids", np.int32).astype(np.int64), col("starts", np.int32), col("rows", np.int32), texts, col("columns", np.int32), col("column_starts", np.int32), col("words", np.float64), col("good", np.bool_), col("train", np.int64)


def _round(points, test: bool):
    """For each model: with test its true and false positives and false negatives; else the loss, and its derivatives by the intercept, the
    number of words and every pair, summed up over its training texts."""

    def run(batches):
        models, weights = points.value  # (split, intercept, weight of the number of words); weights of pairs
        figures, sums = np.zeros((len(models), 3)), np.zeros((0 if test else len(models), weights.shape[1]))
        for ids, starts, rows, texts, columns, column_starts, words, good, train in _read(batches):
            y, at, by = np.where(good, 1.0, -1.0), np.empty(len(ids)), None
            for j, (split, intercept, of_words) in enumerate(models):
                m = intercept + of_words * words
                if len(ids):
                    m[rows] += np.add.reduceat(np.take(weights[j], ids, out=at, mode="clip"), starts)
                own = (train >> split) & 1 == 1
                if test:
                    said, own = m > 0, ~own
                    figures[j] += (said & good & own).sum(), (said & ~good & own).sum(), (~said & good & own).sum()
                    continue
                short = 1 - y * m
                c = np.where(own & (short > 0), -y, 0.0)
                figures[j] += -(c * y * short).sum(), c.sum(), c @ words
                if len(ids):
                    by = texts() if by is None else by
                    sums[j, columns] += np.add.reduceat(np.take(c, by, out=at, mode="clip"), column_starts)
        yield pa.RecordBatch.from_arrays([pa.array([figures.tobytes()], pa.binary()), pa.array([sums.tobytes()], pa.binary())], names=["figures", "sums"])

    return run


def _added(parts) -> tuple[np.ndarray, np.ndarray]:
    """The sums of (figures, sums) over all rows."""
    figures = sums = None
    for batch in parts:
        for f, s in zip(batch.column("figures"), batch.column("sums")):
            f, s = np.frombuffer(f.as_buffer()), np.frombuffer(s.as_buffer())
            figures, sums = (f.copy(), s.copy()) if figures is None else (np.add(figures, f, out=figures), np.add(sums, s, out=sums))
    return (np.zeros(0), np.zeros(0)) if figures is None else (figures, sums)


def _add(batches):
    figures, sums = _added(batches)
    if len(figures):
        yield pa.RecordBatch.from_arrays([pa.array([figures.tobytes()], pa.binary()), pa.array([sums.tobytes()], pa.binary())], names=["figures", "sums"])


def _run(blocks: DataFrame, models: list, weights: np.ndarray, test: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """One job over all blocks: a task for each core, whose results are as large as the weights."""
    sc = blocks.sparkSession.sparkContext
    points = sc.broadcast((models, weights))
    schema = "figures binary, sums binary"
    tasks = max(1, sc.defaultParallelism)
    parts = blocks.drop("moments").coalesce(tasks).mapInArrow(_round(points, test), schema)
    if tasks > DIRECT:
        parts = parts.repartition(math.isqrt(tasks)).mapInArrow(_add, schema)
    figures, sums = _added(parts.toArrow().to_batches())
    points.destroy()
    shape = (len(models), -1)
    return (figures.reshape(shape), sums.reshape(shape)) if len(figures) else (np.zeros((len(models), 3)), np.zeros((len(models), weights.shape[1])))


def _direction(grad: np.ndarray, steps: list, turns: list) -> np.ndarray | None:
    """The quasi-Newton direction, None where the remembered steps say nothing."""
    d, a = grad.copy(), []
    products = [float(s @ t) for s, t in zip(steps, turns)]
    if steps and not products[0] >= 0:
        return None
    for s, t, p in zip(steps, turns, products):
        if p == 0 or math.isnan(p):
            return None
        a.append(float(s @ d) / p)
        d -= a[-1] * t
    if steps:
        d *= products[0] / float(turns[0] @ turns[0])
    for s, t, p, x in reversed(list(zip(steps, turns, products, a))):
        d += (x - float(t @ d) / p) * s
    return -d


def minimise(size: int) -> Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]:
    """Yields points, is sent the value and gradient there, and returns the last point; no coordinate changes its sign within a step.

    The steps, the search along them and the ends of it are those of MLlib's optimizer, which takes no first step whole.
    """
    x = np.zeros(size)
    value, grad = yield x
    first, seen, steps, turns, n, failed = value, [math.inf], [], [], 0, False
    while n < ROUNDS and not (len(seen) > 1 and abs(value - max(seen)) <= TOLERANCE * first) and np.linalg.norm(grad) > max(TOLERANCE * value, 1e-8):
        new = None
        if (d := _direction(grad, steps, turns)) is not None:
            d[~(d * grad < 0)] = 0.0
            slope, side = float(d @ grad), np.sign(np.where(x != 0, x, -grad))
            shrink, alpha, now, tries = (0.1, 0.5 / np.linalg.norm(grad), value, 0) if n < 1 else (0.5, 1.0, value, 0)

            def at(alpha, x=x, d=d, side=side):
                p = x + alpha * d
                return p * (np.sign(p) == side)

            while True:
                if now > value + alpha * slope * 1e-4:
                    factor = shrink
                else:
                    if new is None:
                        p = at(alpha)
                        new = (p, *(yield p))
                    along = float(new[2] @ d)
                    factor = 2.1 if along < 0.9 * slope else shrink if along > -0.9 * slope else 1.0
                if factor == 1.0:
                    break
                if not 1e-10 <= alpha * factor <= 1e10:
                    new = None
                    break
                last, alpha, tries = new, alpha * factor, tries + 1
                p = at(alpha)
                new = (p, *(yield p))
                now = new[1]
                if tries == 20:
                    new = last
                    break
        if new is None:
            if failed:
                return x
            failed, steps, turns = True, [], []
            continue
        steps, turns = [new[0] - x, *steps][:MEMORY], [new[2] - grad, *turns][:MEMORY]
        x, value, grad = new
        seen, n, failed = [*seen, value][-20:], n + 1, False
    return x


class _Split:
    """One split's own columns and their scale; its points hold the pairs, the number of words and the intercept."""

    def __init__(self, columns: np.ndarray, texts: np.ndarray, n: int, words: int, squares: int):
        self.columns, self.n = columns, n
        d = texts[columns].astype(np.float64)
        variance = np.append(d * (n - d), float(n * squares - words * words)) / max(n * (n - 1), 1)
        self.inverse = np.divide(1.0, np.sqrt(variance), out=np.zeros(len(d) + 1), where=variance > 0)
        self.mean = np.append(d, float(words)) / max(n, 1) * self.inverse

    def raw(self, x: np.ndarray) -> tuple[float, np.ndarray]:
        """The intercept and weights of features as they are."""
        return float(x[-1] - x[:-1] @ self.mean), x[:-1] * self.inverse

    def value(self, x: np.ndarray, figures: np.ndarray, sums: np.ndarray) -> tuple[float, np.ndarray]:
        w = x[:-1]
        by_weight = (np.append(sums[self.columns], figures[2]) * self.inverse - figures[1] * self.mean) / self.n + REGULAR * w
        return float(figures[0] / self.n + 0.5 * REGULAR * (w @ w)), np.append(by_weight, figures[1] / self.n)


def held_out(df: DataFrame, key: str, content: str, label: str, seeds: list[int], good: str = "good") -> list[tuple[int, int, int]]:
    """For each seed (at most 62) the true and false positives and the false negatives among the rows outside its training part, by a model of
    that part. Rows without a text or label are left out; a split without training rows calls none good."""
    if not 0 < len(seeds) <= 62:
        raise ValueError("from 1 to 62 seeds")
    k, spark = len(seeds), df.sparkSession
    bags = _bags(df, key, content, label, seeds, good)
    terms = vocabulary(bags, k)
    names = spark.sparkContext.broadcast(terms.column("pair").combine_chunks().cast(pa.string()))
    blocks = staged(bags.mapInArrow(_encode(k, names), _BLOCK).repartition(3 * max(1, spark.sparkContext.defaultParallelism)), "blocks")
    names.destroy()
    sums = dict(blocks.select(F.posexplode("moments").alias("at", "m")).groupBy("at").agg(F.sum("m")).collect())
    member = terms.column("member").to_numpy()
    splits = [_Split(np.flatnonzero(member >> i & 1), terms.column(f"d{i}").to_numpy(), *(sums.get(i + j * k, 0) for j in range(3))) for i in range(k)]

    def ask(points: dict, test: bool = False):
        models, weights = [], np.zeros((len(points), len(member)))
        for j, (i, x) in enumerate(points.items()):
            intercept, w = splits[i].raw(x)
            models.append((i, intercept, float(w[-1])))
            weights[j, splits[i].columns] = w[:-1]
        return _run(blocks, models, weights, test)

    cores = max(1, spark.sparkContext.defaultParallelism)
    at_once = max(1, SENT // (8 * max(len(member), 1) * (cores if cores <= DIRECT else math.isqrt(cores))))
    at_once = math.ceil(k / math.ceil(k / at_once))
    return [f for a in range(0, k, at_once) for f in _together(range(a, min(a + at_once, k)), splits, ask)]


def _together(which: range, splits: list[_Split], ask) -> list[tuple[int, int, int]]:
    found = {i: np.zeros(len(splits[i].columns) + 2) for i in which}
    fits = {i: minimise(len(splits[i].columns) + 2) for i in which if splits[i].n}
    points = {i: next(fit) for i, fit in fits.items()}
    while points:
        figures, sums = ask(points)
        for j, (i, x) in enumerate(list(points.items())):
            try:
                points[i] = fits[i].send(splits[i].value(x, figures[j], sums[j]))
            except StopIteration as end:
                found[i] = end.value
                del points[i]
    return [tuple(map(int, f)) for f in ask(found, test=True)[0]]

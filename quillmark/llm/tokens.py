"""Encoding of a corpus with a public byte-level BPE vocabulary.

Method: a pair occurrence index. Texts are cut into words by the vocabulary's pattern; the distinct words of a partition
that weren't seen before lie behind each other in one linked list of symbols, and every pair of neighbours that has a
rank is mapped to all its positions. Active ranks are taken in ascending order from a heap; all occurrences of a rank are
merged from left to right, and the lists of the neighbouring pairs are updated. A word's ids are kept for later batches.

Defined cases: a null and an empty text give an empty list; strings of special tokens are ordinary text; texts of any
length are encoded in full; unpaired surrogates can't occur in Spark strings; repeated rows are encoded again; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import heapq
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The folder of the public vocabularies; a parameter of every function, never copied.
TOKENIZERS = os.environ.get("QUILLMARK_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Fixed value: the word pattern of the vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words whose ids a Python worker keeps at once, and symbols a worker merges at once; beyond them it starts anew.
KEPT_WORDS, LIST_SYMBOLS = 300_000, 4_000_000

_LOADED: dict[str, tuple] = {}


def vocabulary(path: str) -> tuple[dict[bytes, int], list[bytes]]:
    """(rank of each byte string, byte string of each id); read once in a worker."""
    if path not in _LOADED:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        back = [b""] * (max(ranks.values()) + 1)
        for s, r in ranks.items():
            back[r] = s
        _LOADED[path] = (ranks, back)
    return _LOADED[path]


def merge_words(words: list[bytes], ranks: dict[bytes, int], back: list[bytes]) -> list[list[int]]:
    """The ids of each word, by one pair occurrence index over all of them."""
    sym: list[int] = []
    starts: list[int] = []
    for w in words:
        starts.append(len(sym))
        sym.extend(ranks[w[k : k + 1]] for k in range(len(w)))
        sym.append(-1)  # the end of a word, which pairs with nothing
    n = len(sym)
    right = list(range(1, n + 1))
    left = list(range(-1, n - 1))
    where: dict[int, list[int]] = {}  # rank of the merged pair (its id) -> positions of the left symbols
    memo: dict[tuple[int, int], int] = {}
    heap: list[int] = []

    def note(i: int, j: int) -> None:
        a, b = sym[i], sym[j]
        r = memo.get((a, b))
        if r is None:
            r = memo[(a, b)] = ranks.get(back[a] + back[b], -1)
        if r >= 0:
            if r in where:
                where[r].append(i)
            else:
                where[r] = [i]
                heapq.heappush(heap, r)

    for i in range(n - 1):
        if sym[i] >= 0 and sym[i + 1] >= 0:
            note(i, i + 1)
    while heap:
        r = heapq.heappop(heap)
        places = where.pop(r)
        places.sort()
        for i in places:
            j = right[i]
            if sym[i] < 0 or j >= n or sym[j] < 0 or memo.get((sym[i], sym[j])) != r:
                continue  # a symbol of this pair has been merged meanwhile
            k = right[j]
            sym[i], sym[j] = r, -2
            right[i] = k
            if k < n:
                left[k] = i
                if sym[k] >= 0:
                    note(i, k)
            p = left[i]
            if p >= 0 and sym[p] >= 0:
                note(p, i)
    out = []
    for s, w in zip(starts, words, strict=True):
        ids, i, end = [], s, s + len(w)
        while i < end:
            ids.append(sym[i])
            i = right[i]
        out.append(ids)
    return out


class Encoder:
    """Encodes texts with one vocabulary; keeps the ids of words between calls."""

    def __init__(self, path: str, pattern: str = PATTERN):
        import regex

        self.ranks, self.back = vocabulary(path)
        self.words = regex.compile(pattern).findall
        self.known: dict[str, list[int]] = {}

    def encode(self, texts) -> list[list[int]]:
        cut = [self.words(t) if t else [] for t in texts]
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        known, fresh, size = self.known, {}, 0
        for ws in cut:
            for w in ws:
                if w not in known and w not in fresh:
                    b = w.encode("utf-8")
                    fresh[w] = b
                    size += len(b)
                    if size > LIST_SYMBOLS:
                        self._learn(fresh)
                        fresh, size = {}, 0
        self._learn(fresh)
        out = []
        for ws in cut:
            ids: list[int] = []
            for w in ws:
                ids.extend(known[w])
            out.append(ids)
        return out

    def _learn(self, fresh: dict[str, bytes]) -> None:
        whole, rest = {}, {}
        for w, b in fresh.items():
            r = self.ranks.get(b)
            if r is None:
                rest[w] = b
            else:
                whole[w] = [r]
        self.known.update(whole)
        self.known.update(zip(rest, merge_words(list(rest.values()), self.ranks, self.back), strict=True))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _encode(path: str):
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        e = encoder(path)
        for s in batches:
            yield pd.Series(e.encode(s))

    return F.pandas_udf(ids, T.ArrayType(T.IntegerType()))


def token_ids(text: Column, path: str = f"{TOKENIZERS}/{VOCABULARY}") -> Column:
    """The ids of a text column; an empty list for null and empty texts."""
    return _encode(path)(F.coalesce(text, F.lit("")))


def token_count(text: Column, path: str = f"{TOKENIZERS}/{VOCABULARY}") -> Column:
    def sizes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        e = encoder(path)
        for s in batches:
            yield pd.Series([len(x) for x in e.encode(s)])

    return F.pandas_udf(sizes, T.LongType())(F.coalesce(text, F.lit("")))


def encode_corpus(df: DataFrame, id_col: str, text: str, path: str = f"{TOKENIZERS}/{VOCABULARY}") -> DataFrame:
    """(id, ids) of every row."""
    return df.select(df[id_col], df[text].alias("_text")).withColumn("ids", token_ids(F.col("_text"), path)).drop("_text")

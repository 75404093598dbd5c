"""Acronyms and their expansions: mining from text, validity, clusters of spelling variants, statistics."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmark.functions import text

# Acronyms in brackets, and words that expansions may hold without a letter of the acronym.
CAPITALS = r"\(\s*([A-Z][A-Z\-]*[A-Z]s?)\s*\)"
MIXED = r"\(\s*([A-Z][a-zA-Z0-9\-\+]+)\s*\)"
LINKS = {"of", "in", "and", "to", "for"}
#: Cost of a replacement in the weighted edit distance: dashes and apostrophes, blanks.
DASH, BLANK = 0.5, 0.25
#: Weighted distance for a letter of the expansion under which two spellings are one.
NEAR = 0.1


def weighted_distance(a: str, b: str) -> float:
    """Edit distance in which dashes, apostrophes and blanks are cheap to replace."""
    row = [float(j) for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], float(i)
        for j, y in enumerate(b, 1):
            cost = 0.0 if x == y else DASH if x in "-'" or y in "-'" else BLANK if x == " " or y == " " else 1.0
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + cost)
    return row[-1]


def token_distance(a: list[str], b: list[str]) -> int:
    """Edit distance over whole words."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def _letters_fit(acronym: str, words: list[str]) -> bool:
    """Whether the letters of the acronym are found in order: each word gives its first letter, and may give later ones; link words may give none."""
    letters = acronym.lower()

    def match(k: int, w: int) -> bool:
        if w == len(words):
            return k == len(letters)
        word = words[w].lower()
        if word in LINKS and match(k, w + 1):
            return True
        if k >= len(letters) or not word or word[0] != letters[k]:
            return False
        # The word gives letters[k:m], in order within it.
        at, m = 0, k
        while m < len(letters):
            at = word.find(letters[m], at)
            if at < 0:
                break
            at, m = at + 1, m + 1
            if match(m, w + 1):
                return True
        return False

    return match(0, 0)


def expansion(acronym: str, before: str) -> str | None:
    """The words right before the bracket that the acronym stands for, or None; at most two words a letter are looked at."""
    core = re.sub(r"[^A-Za-z0-9]", "", acronym)
    core = core[:-1] if len(core) > 2 and core.endswith("s") and core[:-1].isupper() else core
    words = before.split()[-2 * max(1, len(core)) :]
    for split in (lambda w: [w], lambda w: [p for p in re.split(r"[-/]", w) if p]):
        for start in range(len(words) - 1, -1, -1):
            chosen = words[start:]
            if chosen[0].lower() in LINKS or any(w[-1:] in ".;:!?" for w in chosen[:-1]):
                continue
            parts = [p for w in chosen for p in split(w)]
            if parts and len(" ".join(chosen)) > len(core) and _letters_fit(core, parts):
                return " ".join(chosen)
    return None


def _expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        found = [expansion(a, b) for a, b in zip(pdf["acronym"], pdf["before"], strict=True)]
        yield pdf.assign(expansion=found)[["id", "acronym", "expansion"]].dropna(subset=["expansion"])


def mine(docs: DataFrame, id_col: str, content: str) -> DataFrame:
    """(id, acronym, expansion): each pair of a document once. Only sentences with a bracketed acronym reach Python."""
    kind = dict(docs.dtypes)[id_col]
    x = docs.select(docs[id_col].alias("id"), F.explode(F.split(docs[content], r"(?<=[.?!])\s+(?=[A-Z])")).alias("s")).filter(F.col("s").rlike(MIXED))
    x = x.withColumn("acronym", F.explode(F.array_distinct(F.regexp_extract_all("s", F.lit(MIXED), F.lit(1)))))
    before = F.expr("substring(s, 1, locate('(', s, greatest(1, locate(acronym, s) - 3)) - 1)")
    x = x.select("id", "acronym", before.alias("before"))
    got = x.mapInPandas(_expand, f"id {kind}, acronym string, expansion string")
    return got.distinct()


def cleaned(pairs: DataFrame) -> DataFrame:
    """pairs with cleaned expansions; those that are no longer than the acronym go."""
    x = pairs.withColumn("expansion", text.clean_expansion(F.col("expansion")))
    return x.filter(~text.bad_acronym(F.col("acronym"), F.col("expansion")))


def _clusters(pdf: pd.DataFrame) -> pd.DataFrame:
    """Greedy clusters of one acronym's expansions, most frequent first; each joins the first cluster whose head is near."""
    pdf = pdf.sort_values(["n", "expansion"], ascending=[False, True])
    heads: list[str] = []
    number = []
    for e in pdf["expansion"]:
        for k, h in enumerate(heads):
            small = abs(len(e) - len(h)) < NEAR * len(h)  # the distance is at least the difference in length
            if e.lower() == h.lower() or (small and weighted_distance(e.lower(), h.lower()) / max(1, len(h)) < NEAR):
                number.append(k + 1)
                break
        else:
            heads.append(e)
            number.append(len(heads))
    return pdf.assign(cluster_id=number, canonical=[heads[k - 1] for k in number])


def cluster_variants(pairs: DataFrame) -> DataFrame:
    """(acronym, expansion, n, cluster_id, canonical): distinct expansions of each acronym, numbered by cluster from 1."""
    n = pairs.groupBy("acronym", "expansion").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy("acronym").applyInPandas(_clusters, "acronym string, expansion string, n long, cluster_id int, canonical string")


def statistics(pairs: DataFrame, clusters: DataFrame) -> DataFrame:
    """One row of figures over pairs(id, acronym, expansion) and their clusters.

    definitions, papers and definitions a paper; acronyms, their distinct expansions (ignoring case) and clusters, with mean and
    sample standard deviation an acronym; acronyms of one cluster; expansions a cluster; definitions and share of the
    most frequent acronym.
    """
    found = pairs.agg(F.count(F.lit(1)).alias("definitions"), F.countDistinct("id").alias("papers"))
    per = clusters.groupBy("acronym").agg(F.countDistinct(F.lower("expansion")).alias("e"), F.countDistinct("cluster_id").alias("k"), F.sum("n").alias("n"))
    each = per.agg(
        F.count(F.lit(1)).alias("acronyms"), F.sum("e").alias("expansions"), F.avg("e").alias("mean_expansions"), F.stddev_samp("e").alias("sd_expansions"),
        F.sum("k").alias("senses"), F.avg("k").alias("mean"), F.stddev_samp("k").alias("sd"), F.count_if(F.col("k") == 1).alias("of_one_sense"), F.max("n").alias("most"),
    )
    x = found.crossJoin(each)  # one row each
    return x.select(
        "*", F.try_divide("definitions", "papers").alias("per_paper"), F.try_divide("expansions", "senses").alias("variants_per_sense"), F.try_divide("most", "definitions").alias("share_of_most")
    )


def weighted_distance_column(a, b):
    """weighted_distance of two columns, null where one is null."""

    def distance(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if p is None or q is None else weighted_distance(p, q) for p, q in zip(x, y, strict=True)], dtype="float64")

    return F.pandas_udf(distance, T.DoubleType())(a, b)

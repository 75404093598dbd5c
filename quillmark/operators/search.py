"""Nearest and containing matches without nested loops, and dictionary annotation."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.runtime import shuffled, staged


#: Queries, and documents, that a task of `nearest` holds at once.
BLOCK = 8192


def _best(queries: pd.DataFrame, docs: pd.DataFrame) -> pd.DataFrame:
    """The best of some documents for each of some queries: products are added up in one array over the documents, term by term."""
    names = ["query", "doc", "cosine"]
    if queries.empty or docs.empty:
        return pd.DataFrame(columns=names)
    docs = docs.sort_values("doc")
    sizes = [len(t) for t in docs["terms"]]
    term, weight, at = np.concatenate(docs["terms"].tolist()), np.concatenate(docs["weights"].tolist()), np.repeat(np.arange(len(docs)), sizes)
    order = np.argsort(term, kind="stable")
    term, weight, at = term[order], weight[order], at[order]
    ids, norm, rows = docs["doc"].to_numpy(), docs["norm"].to_numpy(), []
    for query, terms, weights, size in zip(queries["doc"], queries["terms"], queries["weights"], queries["norm"], strict=True):
        dots = np.zeros(len(docs))
        for i, j, w in zip(np.searchsorted(term, terms, "left"), np.searchsorted(term, terms, "right"), weights / size, strict=True):
            dots[at[i:j]] += weight[i:j] * w
        met = np.flatnonzero(dots)
        if len(met):
            cosine = np.round(dots[met] / norm[met], 9)
            k = int(np.argmax(cosine))
            rows.append((query, ids[met[k]], cosine[k]))
    return pd.DataFrame(rows, columns=names)


def nearest(queries: DataFrame, weights: DataFrame) -> DataFrame:
    """(query, doc, cosine): the most similar document of each query; of equal ones the smallest id. Both are (doc, term, weight).

    A cosine of 0 never wins. Every query meets every document that shares a term with it, block by block: a pair of blocks is a task,
    which keeps one document a query; a row a product would be most of queries times documents.
    """
    vocabulary = staged(queries.filter("weight <> 0").select("term").distinct().withColumn("t", F.monotonically_increasing_id()), "terms")

    def vectors(w: DataFrame) -> DataFrame:
        pair = F.when(F.col("t").isNotNull(), F.struct("t", F.col("weight").cast("double").alias("w")))
        v = w.filter("weight <> 0").join(vocabulary, "term", "left").groupBy("doc").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"), F.collect_list(pair).alias("p"))
        return staged(v.filter(F.size("p") > 0).select("doc", "norm", F.col("p.t").alias("terms"), F.col("p.w").alias("weights")), "vectors")

    q, d = vectors(queries), vectors(weights)
    blocks, parts = (max(1, -(-x.count() // BLOCK)) for x in (q, d))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    own = lambda n: F.pmod(F.xxhash64("doc"), F.lit(n)).cast("int")
    q, d = q.select("*", own(blocks).alias("b"), every(parts).alias("k")), d.select("*", every(blocks).alias("b"), own(parts).alias("k"))
    schema = f"query {dict(q.dtypes)['doc']}, doc {dict(d.dtypes)['doc']}, cosine double"
    c = q.groupBy("b", "k").cogroup(d.groupBy("b", "k")).applyInPandas(_best, schema)
    best = c.groupBy("query").agg(F.max(F.struct("cosine", (-F.col("doc")).alias("m"))).alias("b"))
    return best.select("query", (-F.col("b.m")).alias("doc"), "b.cosine")


#: Buckets of the counts by which the rarest piece of a string is chosen, and strings up to whose number their pieces are broadcast.
BUCKETS, ANCHORS = 1 << 18, 500_000


def _pieces(c: Column, k: int) -> Column:
    """Hashes of the distinct substrings of length k of a string that has them."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - k + 1), lambda i: F.xxhash64(F.substr(c, i, F.lit(k)))))


def _all_pieces(c: Column, sizes: list[int]) -> Column:
    none = F.array().cast("array<bigint>")
    return F.concat(*[F.when(F.length(c) >= k, _pieces(c, k)).otherwise(none) for k in sizes])


def _bucket(piece: Column) -> Column:
    return F.pmod(piece, F.lit(BUCKETS))


def _anchors(df: DataFrame, c: str, sizes: list[int], meets: DataFrame) -> DataFrame:
    """(string, piece): of the pieces of the largest size that fits a string, the one that is rarest in meets(piece), by buckets."""
    seen = F.broadcast(meets.groupBy(_bucket(F.col("piece")).alias("bucket")).agg(F.count(F.lit(1)).alias("n")))
    own = F.lit(None).cast("array<bigint>")
    for k in sizes:
        own = F.when(F.length(c) >= k, _pieces(F.col(c), k)).otherwise(own)
    each = df.select(c, F.explode(own).alias("piece")).withColumn("bucket", _bucket(F.col("piece")))
    # A piece whose bucket is empty stands in no string of meets, so that nothing there contains this one.
    each = each.join(seen, "bucket", "left").groupBy(c).agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "piece")).alias("b"))
    return each.filter("b.n > 0").select(c, F.col("b.piece").alias("piece"))


def contained(values: DataFrame, names: DataFrame, least: int = 4) -> DataFrame:
    """(value, key): for each value(value) the name(name, key) that contains it or is contained in it, of the least difference in length.

    A string is stored under its rarest substring of `least`, 2 or 4 times `least` characters, the longest that fits; the others are looked
    up under all of theirs, whose number grows with a string's length, and compared. Shorter strings only match themselves.
    """
    v = staged(values.select("value").filter("value is not null").distinct(), "values")
    n = staged(names.groupBy("name").agg(F.min("key").alias("key")).filter("name is not null"), "names")
    sizes = [least, 2 * least, 4 * least]
    pieces = lambda df, c: df.select("*", F.explode(_all_pieces(F.col(c), sizes)).alias("piece"))
    in_values, in_names = pieces(v, "value"), pieces(n, "name")
    at = _anchors(n, "name", sizes, in_values).join(shuffled(n), "name")
    some = in_values
    if n.count() <= ANCHORS:  # most pieces of values are no name's: these stay where they are
        some = in_values.join(F.broadcast(at.select("piece").distinct()), "piece", "left_semi")
    inside_value = some.join(shuffled(at), "piece").filter(F.contains("value", "name"))
    inside_name = in_names.join(shuffled(_anchors(v, "value", sizes, in_names)), "piece").filter(F.contains("name", "value"))
    same = v.filter(F.length("value") < least).join(shuffled(n), F.col("value") == F.col("name"))
    hits = union(*[h.select("value", "name", "key") for h in (inside_value, inside_name, same)])
    gap = F.abs(F.length("name") - F.length("value"))
    return hits.groupBy("value").agg(F.min(F.struct(gap.alias("gap"), "key")).alias("b")).select("value", F.col("b.key").alias("key"))


def union(first: DataFrame, *rest: DataFrame) -> DataFrame:
    for r in rest:
        first = first.unionByName(r)
    return first


def word_list(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))


#: First words of names up to which they are broadcast to filter the texts' words; beyond, they are joined by shuffle.
FIRST_WORDS = 200_000


def annotate(docs: DataFrame, id_col: str, content: str, names: DataFrame) -> DataFrame:
    """(id, key, pos): every place (word number from 0) where a name(name, key) stands in a text, word by word, ignoring case.

    A name is looked up by its first word; the words that follow are compared, whatever the length of the longest name.
    """
    n = names.select("key", word_list(F.col("name")).alias("nw")).filter(F.size("nw") > 0).select("key", "nw", F.get("nw", F.lit(0)).alias("w"), F.size("nw").alias("k"))
    d = docs.select(docs[id_col].alias("id"), word_list(docs[content]).alias("dw"))
    longest = n.agg(F.max("k")).first()[0] or 0
    firsts = n.select("w").distinct()
    if firsts.count() <= FIRST_WORDS:
        firsts = F.broadcast(firsts)
    # Words that begin no name stay where they are; the others go out with the few words after them, not with the whole text.
    d = d.select("id", F.posexplode("dw").alias("pos", "w"), "dw").join(firsts, "w", "left_semi").select("id", "pos", "w", F.slice("dw", F.col("pos") + 1, F.lit(longest)).alias("next"))
    return d.join(n, "w").filter((F.slice("next", F.lit(1), F.col("k")) == F.col("nw"))).select("id", "key", "pos")


def sentences(c: Column) -> Column:
    """Sentences by their end marks, trimmed."""
    return F.filter(F.transform(F.regexp_extract_all(c, F.lit(r"([^.?!]+[.?!]*)"), F.lit(1)), lambda s: F.trim(s)), lambda s: s != "")


def insert_absent(target: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of new to append: those whose keys target doesn't have, each key once (null keys are never absent rows)."""
    return new.na.drop(subset=keys).dropDuplicates(keys).join(target.select(*keys), keys, "left_anti")


def assert_unique(df: DataFrame, keys: list[str]) -> None:
    """Raises ValueError with an example if a combination of keys occurs twice."""
    twice = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").limit(1).collect()
    if twice:
        raise ValueError(f"{keys} isn't unique: {twice[0].asDict()}")


def rollback(df: DataFrame, id_col: str, checkpoint: int) -> DataFrame:
    """df as it was before a batch whose first id was the checkpoint."""
    return df.filter(F.col(id_col) < checkpoint)


def temporary_failure(message: Column) -> Column:
    """Messages of failures that say nothing about a site: authentication, name resolution, refused connections."""
    m = F.lower(message)
    return m.contains("peer not authenticated") | m.contains("temporary failure in name resolution") | m.rlike(r" connection\s +.+\s + refused ")

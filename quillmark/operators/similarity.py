"""Document vectors and similarities in long form: (doc, term, weight)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmark.functions import text


def term_counts(docs: DataFrame, id_col: str, words: Column) -> DataFrame:
    """(doc, term, tf)."""
    return docs.select(docs[id_col].alias("doc"), F.explode(words).alias("term")).groupBy("doc", "term").agg(F.count(F.lit(1)).alias("tf"))


def vocabulary(counts: DataFrame) -> DataFrame:
    """(term, df) of term_counts."""
    return counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def tfidf(counts: DataFrame, n_docs: int, augmented: bool = True, only: DataFrame | None = None) -> DataFrame:
    """(doc, term, weight): tf, or 0.5 + 0.5 tf / max tf of the document, times ln(n / df). only(doc): the documents to weigh; df counts all."""
    seen = vocabulary(counts)
    if only is not None:
        counts = counts.join(only.select("doc").distinct(), "doc", "left_semi")
    tf = 0.5 + 0.5 * F.col("tf") / F.max("tf").over(Window.partitionBy("doc")) if augmented else F.col("tf").cast("double")
    w = counts.withColumn("w", tf).join(seen, "term")
    return w.select("doc", "term", (F.col("w") * F.log(F.lit(float(n_docs)) / F.col("df"))).alias("weight"))


def fixed_vectors(counts: DataFrame, vocab: DataFrame) -> DataFrame:
    """Counts restricted to the terms of a given vocabulary(term, term_id)."""
    return counts.join(vocab, "term").select("doc", "term_id", "tf")


def pair_cosine(pairs: DataFrame, weights: DataFrame) -> DataFrame:
    """(a, b, cosine) of given pairs(a, b); 0 where a norm is 0. Only terms that both have meet."""
    norms = weights.groupBy("doc").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    a = weights.select(F.col("doc").alias("a"), "term", F.col("weight").alias("wa"))
    b = weights.select(F.col("doc").alias("b"), "term", F.col("weight").alias("wb"))
    dots = pairs.join(a, "a").join(b, ["b", "term"]).groupBy("a", "b").agg(F.sum(F.col("wa") * F.col("wb")).alias("dot"))
    j = pairs.join(dots, ["a", "b"], "left")
    j = j.join(norms.select(F.col("doc").alias("a"), F.col("norm").alias("na")), "a", "left").join(norms.select(F.col("doc").alias("b"), F.col("norm").alias("nb")), "b", "left")
    n = F.col("na") * F.col("nb")
    return j.select("a", "b", F.when(F.coalesce(n, F.lit(0.0)) == 0, 0.0).otherwise(F.coalesce("dot", F.lit(0.0)) / F.when(n != 0, n)).alias("cosine"))


def versions(docs: DataFrame, group: str, order: list[str], content: str) -> DataFrame:
    """(group, first_id, last_id, first, last): the oldest and the newest content of each group that has more than one."""
    g = docs.groupBy(group).agg(
        F.min_by(F.struct("doc_id", content), F.struct(*order)).alias("o"), F.max_by(F.struct("doc_id", content), F.struct(*order)).alias("l"), F.count(F.lit(1)).alias("n")
    ).filter("n > 1")
    return g.select(group, F.col("o.doc_id").alias("first_id"), F.col("l.doc_id").alias("last_id"), F.col(f"o.{content}").alias("first"), F.col(f"l.{content}").alias("last"))


def drift(pairs: DataFrame, k: int = 5) -> DataFrame:
    """Jaccard similarity and containment (the larger of both directions) of the word shingles of first and last."""
    a, b = F.col("_a"), F.col("_b")
    x = pairs.withColumn("_a", text.shingle_hashes(F.col("first"), k)).withColumn("_b", text.shingle_hashes(F.col("last"), k))
    return x.select(*[c for c in pairs.columns if c not in ("first", "last")], text.jaccard(a, b).alias("similarity"), F.greatest(text.containment(a, b), text.containment(b, a)).alias("containment"))

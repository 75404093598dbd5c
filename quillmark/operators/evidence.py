"""Fusing evidence of several sources into one confidence-weighted table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Confidence of evidence from URLs, entity names, publisher searches, and of approved evidence.
CONFIDENCE = {"u": 1.0, "n": 0.8, "p": 0.2}
APPROVED = 0.95
UNIQUE, SEARCHED = 1, 2


def combine(sources: dict[str, DataFrame]) -> DataFrame:
    """(pubmed_id, registry_id, src, confidence): one row a pair, the evidence of highest confidence; sources hold (pubmed_id, registry_id)."""
    parts = [df.select("pubmed_id", "registry_id", F.lit(s).alias("src"), F.lit(CONFIDENCE[s]).alias("confidence")) for s, df in sources.items()]
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    known = both.filter("pubmed_id is not null and registry_id is not null")
    best = known.groupBy("pubmed_id", "registry_id").agg(F.max(F.struct("confidence", "src")).alias("b"))
    return best.select("pubmed_id", "registry_id", "b.src", "b.confidence")


def with_labels(combined: DataFrame, labels: DataFrame) -> DataFrame:
    """combined after feedback: pairs labelled bad go, good ones get the confidence of approved evidence. labels: (pubmed_id, registry_id, label)."""
    one = labels.groupBy("pubmed_id", "registry_id").agg(F.min("label").alias("label"))  # a bad label outweighs a good one
    j = combined.join(one, ["pubmed_id", "registry_id"], "left").filter("label is null or label <> 'bad'")
    return j.withColumn("confidence", F.when(F.col("label") == "good", APPROVED).otherwise(F.col("confidence"))).drop("label")


def new_pairs(hits: DataFrame, known: list[DataFrame]) -> DataFrame:
    """Hits whose (pubmed_id, registry_id) none of the known tables has."""
    seen = known[0].select("pubmed_id", "registry_id")
    for k in known[1:]:
        seen = seen.unionByName(k.select("pubmed_id", "registry_id"))
    return hits.join(seen.distinct(), ["pubmed_id", "registry_id"], "left_anti")


def flag_unique(refs: DataFrame, known: DataFrame) -> DataFrame:
    """refs with the unique bit set in flags where no known pair exists; other bits stay."""
    seen = known.select("pubmed_id", "registry_id").distinct().withColumn("_seen", F.lit(True))
    j = refs.join(seen, ["pubmed_id", "registry_id"], "left")
    return j.withColumn("flags", F.when(F.col("_seen").isNull(), F.coalesce("flags", F.lit(0)).bitwiseOR(F.lit(UNIQUE))).otherwise(F.col("flags"))).drop("_seen")

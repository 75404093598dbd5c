"""Top N items within every group, whatever the size of the group.

Method: exact group counts; groups with more rows than a task takes (skew.heavy_keys, which bounds their number) are
sorted by range on (group, order), so that one group spreads over many partitions; each partition keeps at most N of
each group, and a last window ranks these few. All other groups go through ordinary windows. The two are united.

Defined cases: rows whose group is null, or whose score is null, NaN or under the floor, never qualify; a null rank
comes after every rank; equal score and rank are ordered by id, so that ids must be unique (repeated ids of a group
keep both places, their order is open); an empty input gives an empty result; groups with fewer rows give what they have.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmark.operators.skew import heavy_keys


def top_n(df: DataFrame, group: str, score: str, rank: str, id_col: str, n: int = 10, floor: float = 0.0) -> DataFrame:
    """(group, pos, id) of the n best rows of each group: highest score, then smallest rank, then smallest id."""
    rows = df.select(
        df[group].alias("g"), (df[score].cast("double") + F.lit(0.0)).alias("s"), df[rank].alias("r"), df[id_col].alias("i")
    ).filter("g is not null and s is not null and not isnan(s)").filter(F.col("s") >= floor)
    counts = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    total = rows.count()
    hot = F.broadcast(heavy_keys(counts, total).select("g"))
    order = [F.col("s").desc(), F.col("r").asc_nulls_last(), F.col("i").asc()]

    light = rows.join(hot, "g", "left_anti").withColumn("pos", F.row_number().over(Window.partitionBy("g").orderBy(*order))).filter(F.col("pos") <= n)

    heavy = rows.join(hot, "g", "left_semi").repartitionByRange(F.col("g"), *order).withColumn("salt", F.spark_partition_id())
    some = heavy.withColumn("k", F.row_number().over(Window.partitionBy("g", "salt").orderBy(*order))).filter(F.col("k") <= n).drop("k", "salt")
    best = some.withColumn("pos", F.row_number().over(Window.partitionBy("g").orderBy(*order))).filter(F.col("pos") <= n)
    return light.unionByName(best).select(F.col("g").alias(group), F.col("pos").cast("int").alias("pos"), F.col("i").alias("id"))

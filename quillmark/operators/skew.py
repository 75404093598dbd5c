"""Joins and splits that hold when one key has a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmark.runtime import staged

#: Heavy keys are at most this many, whatever the data: they have more than 1 / HEAVY_KEYS of all rows. That bounds every broadcast of them.
HEAVY_KEYS = 100_000
#: Rows of one key that a task takes without a split.
TASK_ROWS = 10_000


def heavy_keys(counts: DataFrame, total: int, n: str = "n", least: int = TASK_ROWS) -> DataFrame:
    """The rows of counts (one per key, n rows each) with more than `least` rows and more than 1 / HEAVY_KEYS of total.

    So a light key has at most 10,000 rows up to 10^9 rows, and 10^7 at 10^12.
    """
    return counts.filter(F.col(n) > F.lit(max(least, total // HEAVY_KEYS)))


def split_join(left: DataFrame, right: DataFrame, on: list[str], heavy: DataFrame, n: str = "n", rows: int = TASK_ROWS) -> DataFrame:
    """Inner join of many rows (left) with one row per key (right).

    Keys listed in heavy (with their number of rows n) are salted: their left rows are dealt out to parts of about `rows` rows, and
    their right row goes to each part. Only 64-bit hashes of the heavy keys are broadcast, at most HEAVY_KEYS of 16 bytes; two
    keys of one hash are merely salted alike. Salts depend on the row alone, so a repeated task gives the same rows. Null keys join nothing.
    """
    parts = heavy.groupBy(F.xxhash64(*on).alias("_h")).agg(F.ceil(F.max(n) / rows).cast("int").alias("_parts"))
    parts = F.broadcast(parts)
    last = F.coalesce(F.col("_parts"), F.lit(1)) - 1
    a = left.withColumn("_x", F.xxhash64(*on)).join(parts, F.col("_x") == F.col("_h"), "left")
    a = a.withColumn("_salt", F.when(last > 0, F.pmod(F.xxhash64(*left.columns), last + 1)).otherwise(0).cast("int")).drop("_x", "_h", "_parts")
    b = right.withColumn("_x", F.xxhash64(*on)).join(parts, F.col("_x") == F.col("_h"), "left")
    b = b.withColumn("_salt", F.explode(F.sequence(F.lit(0), last))).drop("_x", "_h", "_parts")
    return a.join(b, [*on, "_salt"]).drop("_salt")


def numbered(df: DataFrame, key: str, order: str, number: str) -> DataFrame:
    """df with the place (from 1) of each row within its key, a key of any size: row_number() without a key's rows in one task.

    Rows are sorted by range on (key, order); a row's place is its place in its partition's stretch of the key plus the
    sizes of the stretches before it. order must be unique within a key.
    """
    r = df.repartitionByRange(key, order).sortWithinPartitions(key, order).withColumn("_m", F.monotonically_increasing_id())
    r = staged(r, "numbered").withColumn("_p", F.shiftright("_m", 33))
    part = r.groupBy("_p", F.col(key).alias("_k")).agg(F.min("_m").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("_k").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    part = part.select(F.col("_p").alias("_q"), "_k", "_first", before.alias("_before"))
    j = r.join(part, (F.col("_p") == F.col("_q")) & F.col(key).eqNullSafe(F.col("_k")))
    return j.withColumn(number, (F.col("_m") - F.col("_first") + F.col("_before") + 1).cast("int")).drop("_m", "_p", "_q", "_k", "_first", "_before")

"""Operators over ordered histories: runs, latest records, survivors of duplicates, inference from the first of a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmark.operators.skew import numbered


def down_runs(log: DataFrame, key: str, order: list[Column], up: Column, least: int = 3) -> DataFrame:
    """(key, run): newest records that failed without a success between, where there are at least that many.

    No window over a key's whole history: the last success is found by aggregation and the failures after it are counted.
    """
    x = log.select(F.col(key).alias("key"), F.struct(*order).alias("o"), up.alias("up"))
    last = x.filter("up").groupBy("key").agg(F.max("o").alias("last"))
    runs = x.filter("not up").join(last, "key", "left").filter("last is null or o > last").groupBy("key").agg(F.count(F.lit(1)).alias("run"))
    return runs.filter(F.col("run") >= least).withColumnRenamed("key", key)


def latest(df: DataFrame, key: str, order: list[str], columns: list[str]) -> DataFrame:
    """The last record of each key, by aggregation."""
    return df.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("r")).select(key, "r.*")


def later_copies(df: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """Rows that repeat an earlier row of equal keys (null keys equal nothing)."""
    known = df.na.drop(subset=keys)
    return known.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(id_col))).filter("_n > 1").drop("_n")


def first_of(df: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """The first row of each combination of keys, by aggregation."""
    return df.groupBy(*keys).agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("r")).select(*keys, "r.*")


def round_robin(df: DataFrame, key: str, id_col: str) -> DataFrame:
    """df with turn: the place of a row within its key, so that ordering by turn deals the keys out one by one."""
    return numbered(df, key, id_col, "turn")


def inferred(df: DataFrame, base: str, id_col: str, value: str) -> DataFrame:
    """df with the value of the first row of equal base; flag 1 checked for that row, 2 inferred for the others."""
    first = df.groupBy(base).agg(F.min_by(F.struct(F.col(value).alias("v"), F.col(id_col).alias("i")), id_col).alias("_f"))
    j = df.join(first, base)
    return j.withColumn(value, F.col("_f.v")).withColumn("flags", F.when(F.col(id_col) == F.col("_f.i"), 1).otherwise(2)).drop("_f")


def capped(df: DataFrame, key: str, always: Column, order: list[str], most: int) -> DataFrame:
    """Rows that are always kept, and of the others those within the first `most` of their key."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter(always | (F.col("_n") <= most)).drop("_n")


def resume_prefix(items: DataFrame, order: str, seen: DataFrame, key: str, time: str) -> DataFrame:
    """Items that were done before in this period: those seen, without the latest one, which may be unfinished."""
    last = seen.groupBy(key).agg(F.max(time).alias("_t"))
    top = last.agg(F.max(F.struct("_t", key)).alias("_m"))
    done = last.join(F.broadcast(top), F.struct("_t", key) < F.col("_m")).select(key)  # top is one row
    return items.join(done, key, "left_semi")

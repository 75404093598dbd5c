"""Append-only logs as streams: site checks to runs of failures, mentions to counts by window, new files to mentions."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STATE = "last timestamp, last_id long, run long"
OUT = "site long, last timestamp, run long, down boolean"


def read_log(spark: SparkSession, path: str, schema) -> DataFrame:
    """A table that only grows, as a stream of its files."""
    return spark.readStream.schema(schema).parquet(path)


def _advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    last, last_id, run = state.get if state.exists else (None, -1, 0)
    rows = pd.concat(list(batches), ignore_index=True).sort_values(["ts", "id"])
    for t, i, up in zip(rows["ts"], rows["id"], rows["up"], strict=True):
        if last is not None and (t, i) <= (pd.Timestamp(last), last_id):
            continue  # a check that came late, or again, doesn't change a newer state
        run = 0 if up else run + 1
        last, last_id = t, i
    state.update((pd.Timestamp(last).to_pydatetime(), int(last_id), int(run)))
    yield pd.DataFrame({"site": [key[0]], "last": [last], "run": [run], "down": [run >= LEAST]})


#: Failures in a row from which a site is down.
LEAST = 3


def down_sites(checks: DataFrame) -> DataFrame:
    """(site, last, run, down) of every site that a micro-batch of checks(site, id, ts, up) touches; the state of a site is three numbers."""
    return checks.groupBy("site").applyInPandasWithState(_advance, OUT, STATE, "update", GroupStateTimeout.NoTimeout)


def counts(log: DataFrame, time: str, key: str, window: str = "1 day", late: str = "2 days") -> DataFrame:
    """(window, key, n): rows by window and key, with a watermark for late ones."""
    return log.withWatermark(time, late).groupBy(F.window(time, window), F.col(key)).agg(F.count(F.lit(1)).alias("n"))


def first_seen(log: DataFrame, key: str, time: str, late: str = "30 days") -> DataFrame:
    """The first row of each key within the watermark."""
    return log.withWatermark(time, late).dropDuplicatesWithinWatermark([key])

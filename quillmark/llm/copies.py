"""Duplicates hidden by formatting differences.

Method: byte-identical raw values are collapsed with counts first; only distinct survivors are canonicalised; these
are grouped again on the full canonical text, summing the counts. Members are listed by a join of the survivors with
their groups, and only raw values that occur more than once are joined back to the rows.

Defined cases: null values are left out, as are rows whose scope is null; a value without any letter or digit has
the empty canonical text, and such values are copies of each other; repeated rows (also of one id) count as often as
they occur but give one link per id; empty input gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.operators.skew import heavy_keys, split_join
from quillmark.runtime import staged


def letters_digits(c: Column) -> Column:
    return F.lower(F.regexp_replace(c, r"[^\p{L}\p{N}]+", ""))


def address(c: Column) -> Column:
    """Canonical address: letters and digits in lower case; the fields after the first '?' (split by & or ;) sorted, empty ones dropped."""
    head, tail = F.substring_index(c, "?", 1), F.regexp_extract(c, r"(?s)^[^?]*\?(.*)$", 1)
    fields = F.array_sort(F.filter(F.transform(F.split(tail, "[&;]"), letters_digits), lambda x: x != ""))
    return F.when(F.instr(c, "?") == 0, letters_digits(c)).otherwise(
        F.concat(letters_digits(head), F.when(F.size(fields) > 0, F.concat(F.lit("?"), F.array_join(fields, "&"))).otherwise(""))
    )


def _survivors(rows: DataFrame, canon) -> DataFrame:
    """One row per scope and raw value: its count n and its smallest id, with the canonical text."""
    raw = rows.groupBy("scope", "raw").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"))
    return raw.withColumn("canon", canon(F.col("raw")))


def _rows(df: DataFrame, id_col: str, value: str, scope: str | None) -> DataFrame:
    s = df[scope].cast("string") if scope else F.lit("")
    return df.select(s.alias("scope"), df[value].alias("raw"), df[id_col].alias("id")).filter("scope is not null and raw is not null and id is not null")


def format_groups(df: DataFrame, id_col: str, value: str, scope: str | None = None, canon=address) -> DataFrame:
    """(scope, canon, keep_id, copies): each distinct record once, with the number of its copies (itself counted)."""
    return _survivors(_rows(df, id_col, value, scope), canon).groupBy("scope", "canon").agg(F.min("first_id").alias("keep_id"), F.sum("n").alias("copies"))


def format_links(df: DataFrame, id_col: str, value: str, scope: str | None = None, canon=address) -> DataFrame:
    """(keep_id, dup_id): for each group its smallest id with every other id."""
    rows = _rows(df, id_col, value, scope)
    raw = staged(_survivors(rows, canon), "survivors")  # the one large aggregation, read four times below
    total = raw.agg(F.sum("n")).first()[0] or 0
    groups = raw.groupBy("scope", "canon").agg(F.min("first_id").alias("keep_id"), F.sum("n").alias("copies"), F.count(F.lit(1)).alias("forms")).filter("copies > 1")
    members = split_join(raw, groups, ["scope", "canon"], heavy_keys(groups, total, "forms"), "forms")
    firsts = members.filter("first_id <> keep_id").select("keep_id", F.col("first_id").alias("dup_id"))
    several = members.filter("n > 1").select("scope", "raw", "keep_id", "first_id", "n")
    again = split_join(rows, several, ["scope", "raw"], heavy_keys(several, total))
    rest = again.filter("id <> first_id and id <> keep_id").select("keep_id", F.col("id").alias("dup_id"))
    return firsts.unionByName(rest).distinct()

"""Queries of the general training-data operators: mixed timestamps (p4) and packed fields (p5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.operators.packed import unpack
from quillmark.operators.timestamps import normalise
from quillmark.runtime import table

_REGISTRY = {"synonym": ",;|", "keyword": ",;|", "resource_type_ids": ",;|"}
#: Whether a comma ends a heading or belongs to it, the dictionary of headings decides.
_HEADINGS = {"mesh_headings": (";|", ",")}


def pieces(spark: SparkSession, d: str, least: int, guided: bool = True) -> DataFrame:
    reg = unpack(table(spark, d, "registry"), "id", _REGISTRY, least)
    ref = unpack(table(spark, d, "rd_paper_reference"), "id", _HEADINGS, least, guided)
    cols = ["field", "id", "pos", "piece"]
    return reg.select(F.lit("registry").alias("tbl"), *cols).unionByName(ref.select(F.lit("rd_paper_reference").alias("tbl"), *cols))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return pieces(spark, d, 2)


def p5_values(spark: SparkSession, d: str) -> DataFrame:
    return pieces(spark, d, 1).groupBy("tbl", "field", "piece").agg(F.count(F.lit(1)).alias("n"))


def dates_of(spark: SparkSession, d: str) -> DataFrame:
    paper = table(spark, d, "rd_paper").select(F.lit("rd_paper").alias("tbl"), "id", F.col("pubdate").alias("value"), F.lit("rd_paper").alias("source"))
    ref = table(spark, d, "rd_paper_reference").select(
        F.lit("rd_paper_reference").alias("tbl"), "id", F.col("publication_date").alias("value"), F.col("publisher_id").cast("string").alias("source")
    )
    return paper.unionByName(ref)


def orders(spark: SparkSession, d: str) -> DataFrame:
    """What is known of each source: the publishers' table, and month first in rd_paper."""
    locale = table(spark, d, "publisher_locale").select(F.col("publisher_id").cast("string").alias("source"), "time_zone", "day_order")
    return locale.unionByName(spark.createDataFrame([("rd_paper", "UTC", "mdy")], "source string, time_zone string, day_order string"))


def _dates(spark: SparkSession, d: str) -> DataFrame:
    return normalise(dates_of(spark, d), orders(spark, d), keys=["tbl", "id"])


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _dates(spark, d).filter("status = 'read' and norm <> value").select("tbl", "id", "norm")


def p4_formats(spark: SparkSession, d: str) -> DataFrame:
    return _dates(spark, d).groupBy("tbl", "source", "format", "status").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {"p4_found": p4_found, "p4_formats": p4_formats, "p5_found": p5_found, "p5_values": p5_values}


def _sql_pieces(tbl: str, field: str, seps: str) -> str:
    # A value: quoted parts whole, else anything but a separator; then trimmed, unquoted, empty ones dropped.
    pattern = f'(?:"(?:[^"]|"")*"|[^{seps}\\t\\n\\r])+'
    value = """CASE WHEN length(w) >= 2 AND w LIKE '"%"' THEN trim(replace(substr(w, 2, length(w) - 2), '""', '"')) ELSE w END"""
    return f"""
SELECT '{tbl}' AS tbl, '{field}' AS field, id, unnest(range(1, len(p) + 1)) AS pos, unnest(p) AS piece FROM (
  SELECT id, list_filter(list_transform(list_transform(regexp_extract_all({field}, '{pattern}'), lambda v: trim(v, '  ')),
    lambda w: {value}), lambda z: z <> '') AS p FROM {tbl} WHERE {field} IS NOT NULL)"""


_PIECES = " UNION ALL ".join(
    [_sql_pieces("registry", f, s) for f, s in _REGISTRY.items()] + [_sql_pieces("rd_paper_reference", f, s) for f, (s, _) in _HEADINGS.items()]
)
SQL = {
    "p5_found": f"WITH a AS ({_PIECES}) SELECT tbl, field, id, CAST(pos AS INTEGER) AS pos, piece FROM a QUALIFY count(*) OVER (PARTITION BY tbl, field, id) >= 2",
    "p5_values": f"WITH a AS ({_PIECES}) SELECT tbl, field, piece, count(*) AS n FROM a GROUP BY ALL",
}

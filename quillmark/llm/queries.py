"""Queries of the training-data operators over the test tables, and their SQL where SQL can express them."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.llm.copies import address, format_groups, format_links
from quillmark.llm.increment import deduplicate_history, host, word_set
from quillmark.llm.mojibake import repair
from quillmark.llm.names import organisations, persons, spelling_links, spellings
from quillmark.llm.packing import fill, pack
from quillmark.llm.tokens import encode_corpus
from quillmark.llm.topn import top_n
from quillmark.llm.truncation import cut_rates, find_cut, values
from quillmark.runtime import shuffled, table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    reg = format_links(table(spark, d, "registry"), "id", "url")
    urls = format_links(table(spark, d, "rd_urls"), "id", "url", scope="doc_id")
    return reg.select(F.lit("registry").alias("tbl"), "keep_id", "dup_id").unionByName(urls.select(F.lit("rd_urls").alias("tbl"), "keep_id", "dup_id"))


def p1_copies(spark: SparkSession, d: str) -> DataFrame:
    reg = format_groups(table(spark, d, "registry"), "id", "url")
    urls = format_groups(table(spark, d, "rd_urls"), "id", "url", scope="doc_id")
    cols = ["keep_id", "canon", "copies"]
    return reg.select(F.lit("registry").alias("tbl"), *cols).unionByName(urls.select(F.lit("rd_urls").alias("tbl"), *cols))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return top_n(table(spark, d, "rd_urls"), "registry_id", "score", "rank", "id", n=10)


def _entities(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    reg = table(spark, d, "registry")
    org = organisations(spellings([(reg, "parent_organization"), (reg, "supporting_agency")]))
    who = persons(spellings([(table(spark, d, "rd_paper_reference"), "authors")], ";"), table(spark, d, "given_name_ref"))
    return org, who


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    org, who = _entities(spark, d)
    return spelling_links(org).select(F.lit("org").alias("kind"), "*").unionByName(spelling_links(who).select(F.lit("person").alias("kind"), "*"))


def p3_entities(spark: SparkSession, d: str) -> DataFrame:
    org, who = _entities(spark, d)
    return org.select(F.lit("org").alias("kind"), "*").unionByName(who.select(F.lit("person").alias("kind"), "*"))


#: Table, field, what a source is, column with an address that the text mentions.
_CUT = [("rd_urls", "context", "batch_id", "url"), ("rd_urls", "description", "batch_id", None), ("rd_resource_candidate", "description", "batch_id", None), ("rd_paper_reference", "title", "publisher_id", None)]


def _texts(spark: SparkSession, d: str) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, [values(table(spark, d, t), f"{t}.{field}", "id", field, source, known) for t, field, source, known in _CUT])


def _named(df: DataFrame, *cols: str) -> DataFrame:
    part = F.split("field", "[.]")
    return df.select(part[0].alias("tbl"), part[1].alias("field"), *cols)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _named(find_cut(_texts(spark, d)), "id")


def p6_rates(spark: SparkSession, d: str) -> DataFrame:
    return _named(cut_rates(_texts(spark, d)), "source", "values", "cut", "share")


def _submissions(spark: SparkSession, d: str) -> DataFrame:
    c, u = table(spark, d, "rd_resource_candidate"), table(spark, d, "rd_urls")
    x = c.select("id", "url_id", "description").join(shuffled(u.select(u["id"].alias("url_id"), "url", "batch_id")), "url_id")
    return x.select("id", F.col("batch_id").alias("batch"), address(F.col("url")).alias("addr"), host(F.col("url")).alias("host"), word_set(F.col("description")).alias("words"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    r = deduplicate_history(_submissions(spark, d))
    return r.select(F.least("id", "repeats").alias("id_a"), F.greatest("id", "repeats").alias("id_b"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode_corpus(table(spark, d, "documents"), "doc_id", "text")


def p9_packed(spark: SparkSession, d: str) -> DataFrame:
    return pack(table(spark, d, "documents"), "doc_id", "text", capacity=2048)


def p9_fill(spark: SparkSession, d: str) -> DataFrame:
    return fill(p9_packed(spark, d), 2048)


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    r = repair(table(spark, d, "documents"), "doc_id", "text", "source")
    return r.select(F.col("id").alias("doc_id"), F.when(F.col("restored") == "", "").otherwise(F.md5("restored")).alias("restored_md5"))


_CANON = """
lower(regexp_replace(CASE WHEN instr(url, '?') = 0 THEN url ELSE substr(url, 1, instr(url, '?') - 1) END, '[^\\p{L}\\p{N}]+', '', 'g'))
|| CASE WHEN instr(url, '?') = 0 THEN '' ELSE coalesce('?' || nullif(list_aggregate(list_sort(list_filter(list_transform(
  regexp_split_to_array(substr(url, instr(url, '?') + 1), '[&;]'), lambda x: lower(regexp_replace(x, '[^\\p{L}\\p{N}]+', '', 'g'))), lambda x: x <> '')),
  'string_agg', '&'), ''), '') END"""

_P1 = f"""
WITH a AS (
  SELECT 'registry' AS tbl, id, '' AS scope, {_CANON} AS canon FROM registry WHERE url IS NOT NULL
  UNION ALL
  SELECT 'rd_urls', id, CAST(doc_id AS VARCHAR), {_CANON} FROM rd_urls WHERE url IS NOT NULL AND doc_id IS NOT NULL
), b AS (SELECT *, min(id) OVER (PARTITION BY tbl, scope, canon) AS keep_id FROM a)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_copies": p1_copies,
    "p2_found": p2_found,
    "p3_found": p3_found,
    "p3_entities": p3_entities,
    "p6_found": p6_found,
    "p6_rates": p6_rates,
    "p7_found": p7_found,
    "p8_ids": p8_ids,
    "p9_packed": p9_packed,
    "p9_fill": p9_fill,
    "p10_found": p10_found,
}

SQL: dict[str, str] = {
    "p1_found": _P1 + "SELECT DISTINCT tbl, keep_id, id AS dup_id FROM b WHERE id <> keep_id",
    "p1_copies": _P1 + "SELECT tbl, keep_id, canon, count(*) AS copies FROM b GROUP BY tbl, scope, keep_id, canon",
    "p2_found": """
SELECT registry_id, CAST(pos AS INTEGER) AS pos, id FROM (
  SELECT registry_id, id, row_number() OVER (PARTITION BY registry_id ORDER BY score DESC, rank ASC NULLS LAST, id) AS pos
  FROM rd_urls WHERE registry_id IS NOT NULL AND score >= 0 AND NOT isnan(score)) WHERE pos <= 10""",
}

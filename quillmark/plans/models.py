"""Queries with Python or MLlib inside, which SQL can't express: acronyms, pages, classifier, topics, weighted distances."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.operators import acronyms, models, svm
from quillmark.runtime import staged, table
from quillmark.sources import pages


def _named(spark, d):
    r = table(spark, d, "registry").filter("resource_name is not null and abbrev is not null")
    return r.select("id", F.concat(F.lit("Data were taken from the "), "resource_name", F.lit(" ("), F.upper("abbrev"), F.lit("). "), F.coalesce("description", F.lit(""))).alias("t"))


def ac01_acronyms(spark: SparkSession, d: str) -> DataFrame:
    return acronyms.mine(_named(spark, d), "id", "t")


def _mined(spark, d):
    return acronyms.cleaned(acronyms.mine(_named(spark, d), "id", "t"))


def ac02_clusters(spark: SparkSession, d: str) -> DataFrame:
    return acronyms.cluster_variants(_mined(spark, d))


def ac03_statistics(spark: SparkSession, d: str) -> DataFrame:
    pairs = staged(_mined(spark, d), "acronyms")
    return acronyms.statistics(pairs, acronyms.cluster_variants(pairs))


def ud17_weighted_distance(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "registry").filter("resource_name is not null and synonym is not null")
    first = F.trim(F.element_at(F.split("synonym", r"[,;|\n]"), 1))
    return r.select("id", acronyms.weighted_distance_column(F.lower("resource_name"), F.lower(first)).alias("distance"))


def _html(spark, d):
    doc = table(spark, d, "documents").filter("text is not null").select("doc_id", "source", "text")
    safe = F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    page = F.concat(F.lit("<html><head><title>"), F.coalesce("source", F.lit("")), F.lit("</title><style>p {}</style></head><body><p>"), F.regexp_replace(safe, "\n", "</p><p>"), F.lit('</p><a href="/about">About us</a></body></html>'))
    return doc.select("doc_id", page.alias("html"))


def ht01_pages(spark: SparkSession, d: str) -> DataFrame:
    p = pages.read_pages(_html(spark, d), "html")
    return p.select("doc_id", "page.title", "page.about", F.size("page.sections").alias("sections"), F.length(pages.page_text(F.col("page.sections"))).alias("length"))


def ht02_descriptions(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "rd_resource_candidate").filter("description is not null").select("id", "title", "description")
    html = F.concat(F.lit("<title>"), F.coalesce("title", F.lit("")), F.lit("</title><p>"), F.regexp_replace("description", r"(?<=[.?!])\s+", "</p><p>"), F.lit("</p>"))
    p = pages.read_pages(c.select("id", html.alias("html")), "html")
    return p.filter("page.description is not null").select("id", "page.description")


def _labelled(spark, d):
    return table(spark, d, "documents").filter("text is not null and kind is not null").select("doc_id", "text", F.when(F.col("kind") == "site", "good").otherwise("bad").alias("class"))


def ml01_classifier(spark: SparkSession, d: str, seeds: range = range(10)) -> DataFrame:
    """Quality on held-out rows for each of ten splits, and the macro average of these (seed null)."""
    found = svm.held_out(staged(_labelled(spark, d), "labelled"), "doc_id", "text", "class", list(seeds))
    every = models.rates(spark.createDataFrame([(s, *f) for s, f in zip(seeds, found)], "seed int, tp bigint, fp bigint, fn bigint"))
    mean = every.agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")], *[F.avg(c).alias(c) for c in ("precision", "recall", "f1")])
    return every.unionByName(mean.select(F.lit(None).cast("int").alias("seed"), "*"))


def _described(spark, d):
    return table(spark, d, "registry").filter("description is not null").select("id", "description")


def ml02_topics(spark: SparkSession, d: str) -> DataFrame:
    return models.topic_words(models.train_topics(_described(spark, d), "description"), 10)


def ml03_document_words(spark: SparkSession, d: str) -> DataFrame:
    x = _described(spark, d)
    return models.document_words(models.train_topics(x, "description"), x, "id", "description")


QUERIES = {f.__name__: f for f in (ac01_acronyms, ac02_clusters, ac03_statistics, ud17_weighted_distance, ht01_pages, ht02_descriptions, ml01_classifier, ml02_topics, ml03_document_words)}
SQL: dict[str, str] = {}

"""Further filters, functions and jobs over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmark.functions import dates, text, url, vectors
from quillmark.operators import history, search, similarity
from quillmark.plans.mining import _TOKENS, _VERSIONS, _versions
from quillmark.plans.relational import _papers, _urls
from quillmark.plans.scalar import host_sql
from quillmark.runtime import table

Q, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


@query("SELECT id FROM rd_urls WHERE resource_type_src <> 1 AND resource_type_src <> 2 AND flags <> 4 UNION ALL SELECT id FROM rd_urls WHERE resource_type_src IS NULL AND flags <> 4")
def fl08_exclusions(spark: SparkSession, d: str) -> DataFrame:
    u = _urls(spark, d, "id", "resource_type_src", "flags").filter("flags <> 4")
    return u.filter("resource_type_src is null or resource_type_src not in (1, 2)").select("id")


@query("SELECT id FROM rd_urls WHERE context LIKE '% hosted by %'")
def fl09_like(spark: SparkSession, d: str) -> DataFrame:
    return _urls(spark, d, "id", "context").filter(F.col("context").like("% hosted by %")).select("id")


@query("SELECT doc_id FROM documents WHERE length(text) > 80 AND regexp_extract(text, 'https?://', 0) = ''")
def fl10_predicates(spark: SparkSession, d: str) -> DataFrame:
    """Any boolean column is a predicate; several are joined by &."""
    long, plain = F.length("text") > 80, ~F.col("text").rlike("https?://")
    return table(spark, d, "documents").filter(long & plain).select("doc_id")


@query("SELECT id, regexp_matches(url, '(?i)\\.(pdf|jpg|gif|bmp|ppt|doc)$') AS media FROM rd_urls")
def fl12_media_links(spark: SparkSession, d: str) -> DataFrame:
    return _urls(spark, d, "id", F.col("url").rlike(url.PAGE_MEDIA_PATTERN).alias("media"))


@query("""SELECT event_id, contains(m, 'peer not authenticated') OR contains(m, 'temporary failure in name resolution') OR regexp_matches(m, ' connection\\s +.+\\s + refused ') AS temporary FROM (
  SELECT event_id, lower(CASE event_type WHEN 'error' THEN 'Peer not authenticated' WHEN 'click' THEN ' connection   to host   refused ' ELSE event_type END) AS m FROM events)""")
def fl14_temporary_failures(spark: SparkSession, d: str) -> DataFrame:
    message = F.when(F.col("event_type") == "error", "Peer not authenticated").when(F.col("event_type") == "click", " connection   to host   refused ").otherwise(F.col("event_type"))
    return table(spark, d, "events").select("event_id", search.temporary_failure(message).alias("temporary"))


@query(f"SELECT id FROM rd_urls WHERE {host_sql('url')} <> 'vehitabupa.example.org' AND description IS NULL")
def fl15_undescribed(spark: SparkSession, d: str) -> DataFrame:
    u = _urls(spark, d, "id", url.host(F.col("url")).alias("host"), "description")
    return u.filter("host <> 'vehitabupa.example.org' and description is null").select("id")


@query("SELECT id, c_score FROM rd_paper_reference WHERE c_score >= 0.8 AND NOT isnan(c_score)")
def fl22_threshold(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "rd_paper_reference").filter("c_score >= 0.8 and not isnan(c_score)").select("id", "c_score")


@query("""SELECT l.id FROM (SELECT id, publisher_id, row_number() OVER (PARTITION BY publisher_id ORDER BY exec_time, id) AS k FROM rd_publisher_query_log) l JOIN rd_publisher p ON l.publisher_id = p.id WHERE k <= p.connections_allowed / 100 - 10""")
def so07_quota(spark: SparkSession, d: str) -> DataFrame:
    log = table(spark, d, "rd_publisher_query_log").select("id", "publisher_id", "exec_time")
    allowed = table(spark, d, "rd_publisher").select(F.col("id").alias("publisher_id"), (F.col("connections_allowed") / 100 - 10).alias("most"))
    k = log.withColumn("k", F.row_number().over(Window.partitionBy("publisher_id").orderBy("exec_time", "id")))
    return k.join(allowed, "publisher_id").filter("k <= most").select("id")


@query("""SELECT id, CASE WHEN instr(url, '//') > 0 THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || '/about' END AS about FROM registry WHERE regexp_matches(url, '^[a-z]+://[a-z]')""")
def st20_resolve(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "registry").filter(F.col("url").rlike("^[a-z]+://[a-z]"))
    return r.select("id", url.resolve(F.lit("/about"), F.col("url")).alias("about"))


@query("""SELECT id, alt_url IS NOT NULL AND regexp_replace(regexp_replace(lower(url), '^https?://(www\\.)?', ''), '/$', '') <> regexp_replace(regexp_replace(lower(alt_url), '^https?://(www\\.)?', ''), '/$', '') AS away
FROM registry WHERE url IS NOT NULL""")
def st21_redirects(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "registry").filter("url is not null").select("id", url.redirects_away(F.col("url"), F.col("alt_url")).alias("away"))


@query(f"""WITH t AS (SELECT doc_id, unnest({_TOKENS}) AS term FROM documents WHERE text IS NOT NULL), c AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY 1, 2)
SELECT doc_id, term, round(0.5 + 0.5 * tf / max(tf) OVER (PARTITION BY doc_id), 6) AS weight FROM c""")
def mt04_augmented_tf(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").filter("text is not null").select("doc_id", "text")
    c = similarity.term_counts(docs, "doc_id", text.tokens(F.col("text")))
    w = 0.5 + 0.5 * F.col("tf") / F.max("tf").over(Window.partitionBy("doc"))
    return c.select(F.col("doc").alias("doc_id"), "term", F.round(w, 6).alias("weight"))


@query("""WITH c AS (SELECT user_id, [count(*) FILTER (event_type = 'view'), count(*) FILTER (event_type = 'click')] AS c FROM events GROUP BY 1)
SELECT user_id, abs(list_sum(c) / CAST(greatest(list_sum(c), 1) AS DOUBLE) - 1) < 1e-4 AS distribution FROM c""")
def mt09_distribution(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "events").groupBy("user_id").agg(F.array(*[F.count_if(F.col("event_type") == k).cast("double") for k in ("view", "click")]).alias("c"))
    total = F.greatest(F.aggregate("c", F.lit(0.0), lambda s, x: s + x), F.lit(1.0))
    return c.select("user_id", vectors.is_distribution(F.transform("c", lambda x: x / total)).alias("distribution"))


@query(f"""WITH t AS (SELECT doc_id, unnest({_TOKENS}) AS term FROM documents WHERE text IS NOT NULL), v AS (SELECT term, row_number() OVER (ORDER BY term) AS term_id FROM (SELECT term FROM t GROUP BY 1 HAVING count(DISTINCT doc_id) >= 50))
SELECT doc_id, term_id, count(*) AS tf FROM t JOIN v USING (term) GROUP BY 1, 2""")
def tx06_fixed_vectors(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").filter("text is not null").select("doc_id", "text")
    c = similarity.term_counts(docs, "doc_id", text.tokens(F.col("text")))
    frequent = similarity.vocabulary(c).filter("df >= 50").select("term")
    vocab = frequent.withColumn("term_id", F.row_number().over(Window.orderBy("term")))  # terms in every fiftieth document or more: a small list
    return similarity.fixed_vectors(c, vocab).select(F.col("doc").alias("doc_id"), "term_id", "tf")


@query("""SELECT u.id, coalesce(n.context, u.context) AS context FROM rd_urls u LEFT JOIN (SELECT doc_id, url, arg_max(context, id) AS context FROM rd_urls WHERE batch_id = '201512' AND context IS NOT NULL AND doc_id IS NOT NULL GROUP BY 1, 2) n
ON n.doc_id = u.doc_id AND n.url = u.url WHERE u.batch_id <> '201512' OR u.batch_id IS NULL""")
def pi02_refresh_context(spark: SparkSession, d: str, batch: str = "201512") -> DataFrame:
    u = _urls(spark, d, "id", "doc_id", "url", "context", "batch_id")
    new = u.filter((F.col("batch_id") == batch) & F.col("context").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id", "url").agg(F.max_by("context", "id").alias("_c"))
    old = u.filter((F.col("batch_id") != batch) | F.col("batch_id").isNull())
    return old.join(new, ["doc_id", "url"], "left").select("id", F.coalesce("_c", "context").alias("context"))


@query("""SELECT r.id, coalesce(r.authors, o.authors) AS authors, CASE WHEN trim(coalesce(r.description, '')) = '' THEN o.description ELSE r.description END AS description FROM rd_paper_reference r LEFT JOIN (
  SELECT pubmed_id, registry_id, arg_max(authors, id) FILTER (authors IS NOT NULL) AS authors, arg_max(description, id) FILTER (description IS NOT NULL) AS description FROM rd_paper_reference WHERE pubmed_id IS NOT NULL AND registry_id IS NOT NULL GROUP BY 1, 2) o
  ON o.pubmed_id = r.pubmed_id AND o.registry_id = r.registry_id""")
def pi07_enrich(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "rd_paper_reference").select("id", "pubmed_id", "registry_id", "authors", "description")
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("id"))).alias(f"_{c}")
    o = r.na.drop(subset=["pubmed_id", "registry_id"]).groupBy("pubmed_id", "registry_id").agg(last("authors"), last("description"))
    empty = F.trim(F.coalesce("description", F.lit(""))) == ""
    j = r.join(o, ["pubmed_id", "registry_id"], "left")
    return j.select("id", F.coalesce("authors", "_authors").alias("authors"), F.when(empty, F.col("_description")).otherwise(F.col("description")).alias("description"))


@query("""SELECT id, coalesce(nullif(trim(title), ''), '(none)') AS title, regexp_extract(file_path, '([12]\\d\\d\\d)_[A-Z][a-z][a-z]_\\d{1,2}[\\(_]', 1) AS year FROM rd_paper WHERE pubmed_id IS NOT NULL""")
def pi19_paper_repair(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "rd_paper").filter("pubmed_id is not null")
    return p.select("id", F.coalesce(F.nullif(F.trim("title"), F.lit("")), F.lit("(none)")).alias("title"), F.regexp_extract("file_path", dates.FILE_DATE, 1).alias("year"))


@query(f"""WITH {_VERSIONS} SELECT registry_id, first_id AS doc_id, 1 AS flags FROM v UNION ALL SELECT registry_id, last_id, 2 FROM v""")
def pi21_snapshots(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").filter("text is not null and registry_id is not null and batch_id is not null")
    both = F.struct("batch_id", "doc_id")
    g = docs.groupBy("registry_id").agg(F.min_by("doc_id", both).alias("a"), F.max_by("doc_id", both).alias("b"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return g.select("registry_id", F.explode(F.array(F.struct(F.col("a").alias("doc_id"), F.lit(1).alias("flags")), F.struct(F.col("b").alias("doc_id"), F.lit(2).alias("flags")))).alias("s")).select("registry_id", "s.doc_id", "s.flags")


@query("SELECT id FROM rd_paper_reference WHERE id NOT IN (SELECT id FROM rd_paper_reference WHERE registry_id IS NOT NULL AND pubmed_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY registry_id, pubmed_id ORDER BY id) > 1)")
def sk05_delete_copies(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "rd_paper_reference").select("id", "registry_id", "pubmed_id")
    gone = history.later_copies(r, ["registry_id", "pubmed_id"], "id").select("id")
    return r.select("id").join(gone, "id", "left_anti")


@query("SELECT id, publisher_id FROM rd_publisher_query_log WHERE registry_id IS NULL OR registry_id NOT IN (SELECT id FROM registry WHERE url IS NULL)")
def sk06_cascade(spark: SparkSession, d: str) -> DataFrame:
    gone = table(spark, d, "registry").filter("url is null").select(F.col("id").alias("registry_id"))
    return table(spark, d, "rd_publisher_query_log").select("id", "publisher_id", "registry_id").join(gone, "registry_id", "left_anti").select("id", "publisher_id")


@query("SELECT batch_id, 'extract' AS operation, 'finished' AS status, count(*) AS rows FROM rd_urls GROUP BY 1")
def sk14_job_log(spark: SparkSession, d: str) -> DataFrame:
    return _urls(spark, d, "batch_id").groupBy("batch_id").agg(F.count(F.lit(1)).alias("rows")).select("batch_id", F.lit("extract").alias("operation"), F.lit("finished").alias("status"), "rows")


@query("""WITH l AS (SELECT doc_id, arg_max(status, (batch_id, id)) AS label FROM (SELECT c.id, c.status, c.batch_id, u.doc_id FROM rd_resource_candidate c JOIN rd_urls u ON c.url_id = u.id WHERE u.doc_id IS NOT NULL AND c.status IS NOT NULL) GROUP BY 1)
SELECT u.id, l.label FROM rd_urls u JOIN l USING (doc_id)""")
def pi14_labels(spark: SparkSession, d: str) -> DataFrame:
    """The newest label given to a mention of a paper, for all mentions of the paper."""
    c = table(spark, d, "rd_resource_candidate").filter("status is not null").select("id", "status", "batch_id", "url_id")
    u = _urls(spark, d, F.col("id").alias("url_id"), "doc_id").filter("doc_id is not null")
    label = history.latest(c.join(u, "url_id"), "doc_id", ["batch_id", "id"], [F.col("status").alias("label")])
    return _urls(spark, d, "id", "doc_id").join(label, "doc_id").select("id", "label")


@query("""SELECT p.pubmed_id, count(DISTINCT u.registry_id) AS resources FROM rd_paper p JOIN rd_urls u ON u.doc_id = p.id WHERE p.pubmed_id IS NOT NULL GROUP BY 1""")
def ag18_resources_per_paper(spark: SparkSession, d: str) -> DataFrame:
    pairs = _urls(spark, d, "doc_id", "registry_id").join(_papers(spark, d).filter("pubmed_id is not null"), "doc_id").select("pubmed_id", "registry_id").distinct()
    return pairs.groupBy("pubmed_id").agg(F.count("registry_id").alias("resources"))


QUERIES = Q

"""Searches: nearest documents, containing hosts, dictionary annotation, sentences, insertion of absent rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmark.functions import text, url
from quillmark.operators import search, similarity
from quillmark.plans.scalar import host_sql
from quillmark.runtime import staged, table

Q, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


_STOP = ", ".join(f"'{w}'" for w in text.STOP_WORDS)
_TOKENS = f"list_filter(list_transform(regexp_extract_all(description, '{text.TOKEN_PATTERN}', 1), lambda w: lower(w)), lambda w: NOT list_contains([{_STOP}], w))"


@query(f"""WITH t AS (SELECT 'r' AS side, id, unnest({_TOKENS}) AS term FROM registry UNION ALL SELECT 'q', id, unnest({_TOKENS}) FROM rd_resource_candidate WHERE id % 100 = 0),
c AS (SELECT side, id, term, count(*) AS tf FROM t GROUP BY ALL), f AS (SELECT term, ln((SELECT count(*) FROM registry WHERE description IS NOT NULL) / CAST(count(*) AS DOUBLE)) AS idf FROM c WHERE side = 'r' GROUP BY 1),
w AS (SELECT side, id, term, tf * idf AS weight FROM c JOIN f USING (term) WHERE tf * idf <> 0), n AS (SELECT side, id, sqrt(sum(weight * weight)) AS norm FROM w GROUP BY 1, 2),
s AS (SELECT a.id AS query, b.id AS doc, sum(a.weight * b.weight) AS dot FROM w a JOIN w b ON a.side = 'q' AND b.side = 'r' AND a.term = b.term GROUP BY 1, 2),
x AS (SELECT query, doc, round(dot / (p.norm * r.norm), 6) AS cosine FROM s JOIN n p ON p.side = 'q' AND p.id = query JOIN n r ON r.side = 'r' AND r.id = doc)
SELECT query, max(cosine) AS cosine FROM x GROUP BY 1""")
def jo14_nearest(spark: SparkSession, d: str) -> DataFrame:
    """Queries: every candidate whose id is divisible by 100, against all registry rows. Ties of the document are open in SQL, so the cosine is compared."""
    reg = table(spark, d, "registry").filter("description is not null").select("id", "description")
    cand = table(spark, d, "rd_resource_candidate").filter("id % 100 = 0 and description is not null").select("id", "description")
    words = text.tokens(F.col("description"))
    counts = staged(similarity.term_counts(reg, "id", words), "counts")
    idf = similarity.vocabulary(counts).select("term", F.log(F.lit(float(max(1, reg.count()))) / F.col("df")).alias("idf"))
    weigh = lambda c: c.join(idf, "term").select("doc", "term", (F.col("tf") * F.col("idf")).alias("weight"))
    got = search.nearest(weigh(similarity.term_counts(cand, "id", words)), weigh(counts))
    return got.select("query", F.round("cosine", 6).alias("cosine"))


@query(f"""WITH v AS (SELECT DISTINCT {host_sql('url')} AS value FROM rd_urls WHERE {host_sql('url')} IS NOT NULL), n AS (SELECT {host_sql('url')} AS name, min(id) AS key FROM registry WHERE {host_sql('url')} IS NOT NULL GROUP BY 1)
SELECT value, arg_min(key, (abs(length(name) - length(value)), key)) AS key FROM v JOIN n ON (contains(value, name) AND length(name) >= 4) OR (contains(name, value) AND length(value) >= 4) OR name = value GROUP BY 1""")
def jo15_containing_host(spark: SparkSession, d: str) -> DataFrame:
    h = url.host(F.col("url"))
    return search.contained(table(spark, d, "rd_urls").select(h.alias("value")), table(spark, d, "registry").select(h.alias("name"), F.col("id").alias("key")))


_W = "regexp_extract_all(lower({}), '([\\p{{L}}\\p{{N}}]+)', 1)"


@query(f"""WITH n AS (SELECT id AS key, w AS nw, w[1] AS w, len(w) AS k FROM (SELECT min(id) AS id, {_W.format('resource_type')} AS w FROM registry WHERE resource_type IS NOT NULL GROUP BY resource_type) WHERE len(w) BETWEEN 1 AND 16),
d AS (SELECT doc_id, dw, unnest(range(len(dw))) AS pos FROM (SELECT doc_id, {_W.format('text')} AS dw FROM documents WHERE text IS NOT NULL))
SELECT doc_id AS id, key, pos FROM d JOIN n ON d.dw[pos + 1] = n.w WHERE d.dw[pos + 1 : pos + k] = nw""")
def tx16_annotations(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "registry").filter("resource_type is not null").groupBy(F.col("resource_type").alias("name")).agg(F.min("id").alias("key"))
    return search.annotate(table(spark, d, "documents").filter("text is not null"), "doc_id", "text", names)


@query(f"""WITH n AS (SELECT id AS key, w AS nw, w[1] AS w, len(w) AS k FROM (SELECT min(id) AS id, {_W.format('resource_name')} AS w FROM registry WHERE resource_name IS NOT NULL GROUP BY resource_name) WHERE len(w) > 0),
d AS (SELECT doc_id, dw, unnest(range(len(dw))) AS pos FROM (SELECT doc_id, {_W.format('text')} AS dw FROM documents WHERE text IS NOT NULL))
SELECT doc_id AS id, key, pos FROM d JOIN n ON d.dw[pos + 1] = n.w WHERE d.dw[pos + 1 : pos + k] = nw""")
def tx18_name_annotations(spark: SparkSession, d: str) -> DataFrame:
    """The gazetteer annotator over all names of the registry; tx16_annotations is the one over its types."""
    names = table(spark, d, "registry").filter("resource_name is not null").groupBy(F.col("resource_name").alias("name")).agg(F.min("id").alias("key"))
    return search.annotate(table(spark, d, "documents").filter("text is not null"), "doc_id", "text", names)


@query("SELECT doc_id, len(list_filter(list_transform(regexp_extract_all(text, '([^.?!]+[.?!]*)', 1), lambda s: trim(s, ' ')), lambda s: s <> '')) AS sentences FROM documents WHERE text IS NOT NULL")
def tx17_sentences(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").filter("text is not null").select("doc_id", F.size(search.sentences(F.col("text"))).alias("sentences"))


@query("""WITH t AS (SELECT doc_id, url FROM rd_urls WHERE batch_id < '201506'), n AS (SELECT DISTINCT doc_id, url FROM rd_urls WHERE batch_id >= '201506' AND doc_id IS NOT NULL AND url IS NOT NULL)
SELECT n.doc_id, n.url FROM n WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.doc_id = n.doc_id AND t.url = n.url)""")
def sk02_insert_absent(spark: SparkSession, d: str, batch: str = "201506") -> DataFrame:
    u = table(spark, d, "rd_urls").select("doc_id", "url", "batch_id")
    return search.insert_absent(u.filter(F.col("batch_id") < batch), u.filter(F.col("batch_id") >= batch).select("doc_id", "url"), ["doc_id", "url"])


@query("SELECT id FROM rd_paper_reference WHERE id < (SELECT max(id) // 2 FROM rd_paper_reference)")
def sk08_rollback(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "rd_paper_reference").select("id")
    middle = r.agg(F.max("id")).first()[0]
    return search.rollback(r, "id", (middle or 0) // 2)


@query(f"""SELECT host, to_json({{host: host, paths: paths}}) AS tree FROM (SELECT host, list({{path: path, n: n}} ORDER BY n DESC, path) AS paths FROM (
  SELECT {host_sql('url')} AS host, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path, count(*) AS n FROM rd_urls GROUP BY 1, 2
  QUALIFY row_number() OVER (PARTITION BY host ORDER BY count(*) DESC, path) <= 11) WHERE host IS NOT NULL GROUP BY 1)""")
def sk11_host_tree(spark: SparkSession, d: str) -> DataFrame:
    """The eleven largest paths of each host, as a tree."""
    u = F.col("url")
    n = table(spark, d, "rd_urls").select(url.host(u).alias("host"), url.path(u).alias("path")).filter("host is not null").groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"))
    top = n.withColumn("k", F.row_number().over(Window.partitionBy("host").orderBy(F.desc("n"), "path"))).filter("k <= 11")
    paths = F.transform(F.array_sort(F.collect_list(F.struct("k", "path", "n"))), lambda s: F.struct(s["path"].alias("path"), s["n"].alias("n")))
    return top.groupBy("host").agg(paths.alias("paths")).select("host", F.to_json(F.struct("host", "paths")).alias("tree"))


QUERIES = Q

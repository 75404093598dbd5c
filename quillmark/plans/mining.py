"""Text mining, similarity and pipelines over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.functions import text, url, vectors
from quillmark.operators import evidence, history, lookup, similarity
from quillmark.plans.relational import _KEYS, _VARIANTS, _known_by_url, _papers, _urls
from quillmark.plans.scalar import host_sql, registry_form_sql
from quillmark.runtime import table

Q, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


_STOP = ", ".join(f"'{w}'" for w in text.STOP_WORDS)
_TOKENS = f"list_filter(list_transform(regexp_extract_all(text, '{text.TOKEN_PATTERN}', 1), lambda w: lower(w)), lambda w: NOT list_contains([{_STOP}], w))"
_WORDS = "list_filter(regexp_split_to_array(lower(trim(text, ' ')), '\\s+'), lambda w: w <> '')"


def _docs(spark, d, *cols):
    return table(spark, d, "documents").filter("text is not null").select("doc_id", "text", *cols)


@query(f"SELECT doc_id, len({_TOKENS}) AS tokens, len(list_distinct({_TOKENS})) AS terms FROM documents WHERE text IS NOT NULL")
def tx01_tokens(spark: SparkSession, d: str) -> DataFrame:
    t = _docs(spark, d).select("doc_id", text.tokens(F.col("text")).alias("t"))
    return t.select("doc_id", F.size("t").alias("tokens"), F.size(F.array_distinct("t")).alias("terms"))


@query(f"""SELECT bigram, count(*) AS n FROM (SELECT unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS bigram FROM (SELECT {_WORDS} AS w FROM documents WHERE text IS NOT NULL)) GROUP BY 1""")
def tx02_bigrams(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select(F.explode(text.bigrams(text.plain_words(F.col("text")))).alias("bigram")).groupBy("bigram").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH w AS (SELECT {_WORDS} AS w FROM documents WHERE text IS NOT NULL), p AS (SELECT unnest(list_transform(range(1, len(w)), lambda i: [w[i], w[i + 1]])) AS p FROM w)
SELECT p[1] || ' ' || regexp_replace(p[2], '[.,;:?!]$', '') AS bigram, count(*) AS n FROM p WHERE NOT regexp_matches(p[1], '[.,;:?!]$') AND p[1] NOT IN ({_STOP}) AND regexp_replace(p[2], '[.,;:?!]$', '') NOT IN ({_STOP}) GROUP BY 1""")
def tx03_content_bigrams(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select(F.explode(text.content_bigrams(F.col("text"))).alias("bigram")).groupBy("bigram").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT term, count(*) AS df FROM (SELECT unnest(list_distinct({_TOKENS})) AS term FROM documents WHERE length(text) > 80) GROUP BY 1")
def tx04_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    return similarity.vocabulary(similarity.term_counts(_docs(spark, d).filter("length(text) > 80"), "doc_id", text.tokens(F.col("text"))))


_TFIDF = f"""t AS (SELECT doc_id, unnest({_TOKENS}) AS term FROM documents WHERE text IS NOT NULL), c AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY 1, 2),
df AS (SELECT term, count(*) AS df FROM c GROUP BY 1), n AS (SELECT count(*) AS n FROM documents WHERE text IS NOT NULL),
w AS (SELECT doc_id, term, (0.5 + 0.5 * tf / max(tf) OVER (PARTITION BY doc_id)) * ln(n / CAST(df AS DOUBLE)) AS weight FROM c JOIN df USING (term), n)"""


def _weights(spark, d, only=None):
    docs = _docs(spark, d)
    return similarity.tfidf(similarity.term_counts(docs, "doc_id", text.tokens(F.col("text"))), docs.count(), only=only)


@query(f"WITH {_TFIDF} SELECT doc_id, count(*) AS terms, round(sum(weight), 5) AS total, round(sqrt(sum(weight * weight)), 5) AS norm FROM w GROUP BY 1")
def tx05_tfidf(spark: SparkSession, d: str) -> DataFrame:
    w = _weights(spark, d).groupBy(F.col("doc").alias("doc_id"))
    return w.agg(F.count(F.lit(1)).alias("terms"), F.round(F.sum("weight"), 5).alias("total"), F.round(F.sqrt(F.sum(F.col("weight") * F.col("weight"))), 5).alias("norm"))


_VERSIONS = """v AS (SELECT registry_id, arg_min(doc_id, (batch_id, doc_id)) AS first_id, arg_max(doc_id, (batch_id, doc_id)) AS last_id FROM documents
  WHERE text IS NOT NULL AND registry_id IS NOT NULL AND batch_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"""


def _versions(spark, d):
    docs = _docs(spark, d, "registry_id", "batch_id").filter("registry_id is not null and batch_id is not null")
    return similarity.versions(docs, "registry_id", ["batch_id", "doc_id"], "text")


@query(f"""WITH {_TFIDF}, {_VERSIONS}, norms AS (SELECT doc_id, sqrt(sum(weight * weight)) AS norm FROM w GROUP BY 1),
dots AS (SELECT registry_id, sum(a.weight * b.weight) AS dot FROM v JOIN w a ON a.doc_id = first_id JOIN w b ON b.doc_id = last_id AND b.term = a.term GROUP BY 1)
SELECT v.first_id, v.last_id, round(CASE WHEN coalesce(x.norm * y.norm, 0) = 0 THEN 0 ELSE coalesce(dot, 0) / (x.norm * y.norm) END, 6) AS cosine
FROM v LEFT JOIN dots USING (registry_id) LEFT JOIN norms x ON x.doc_id = first_id LEFT JOIN norms y ON y.doc_id = last_id""")
def tx07_version_cosine(spark: SparkSession, d: str) -> DataFrame:
    v = _versions(spark, d).select(F.col("first_id").alias("a"), F.col("last_id").alias("b"))
    c = similarity.pair_cosine(v, _weights(spark, d, v.select(F.explode(F.array("a", "b")).alias("doc"))))
    return c.select(F.col("a").alias("first_id"), F.col("b").alias("last_id"), F.round("cosine", 6).alias("cosine"))


@query(f"""WITH {_VERSIONS}, s AS (SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: w[i] || '|' || w[i+1] || '|' || w[i+2] || '|' || w[i+3] || '|' || w[i+4] || '|')) ELSE [] END AS s
  FROM (SELECT doc_id, {_WORDS} AS w FROM documents WHERE text IS NOT NULL)), p AS (SELECT registry_id, a.s AS a, b.s AS b, len(list_intersect(a.s, b.s)) AS shared FROM v JOIN s a ON a.doc_id = first_id JOIN s b ON b.doc_id = last_id)
SELECT registry_id, round(CASE WHEN len(a) = 0 OR len(b) = 0 THEN 0 ELSE shared / CAST(len(a) + len(b) - shared AS DOUBLE) END, 6) AS similarity,
  round(CASE WHEN len(a) = 0 OR len(b) = 0 THEN 0 ELSE shared / CAST(least(len(a), len(b)) AS DOUBLE) END, 6) AS containment FROM p""")
def mt01_drift(spark: SparkSession, d: str) -> DataFrame:
    x = similarity.drift(_versions(spark, d))
    return x.select("registry_id", F.round("similarity", 6).alias("similarity"), F.round("containment", 6).alias("containment"))


@query("""SELECT a.vec_id AS a, b.vec_id AS b, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 5) AS cosine
FROM (SELECT label, min(vec_id) AS x, max(vec_id) AS y FROM embeddings GROUP BY 1) g JOIN embeddings a ON a.vec_id = x JOIN embeddings b ON b.vec_id = y""")
def mt06_embedding_cosine(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    g = e.groupBy("label").agg(F.min_by(F.struct("vec_id", "embedding"), "vec_id").alias("x"), F.max_by(F.struct("vec_id", "embedding"), "vec_id").alias("y"))
    return g.select(F.col("x.vec_id").alias("a"), F.col("y.vec_id").alias("b"), F.round(vectors.cosine(F.col("x.embedding"), F.col("y.embedding")), 5).alias("cosine"))


@query("""WITH p AS (SELECT user_id, [count(*) FILTER (event_type = 'view'), count(*) FILTER (event_type = 'click'), count(*) FILTER (event_type = 'signup')] AS c FROM events GROUP BY 1),
n AS (SELECT user_id, list_transform(c, lambda x: x / CAST(list_sum(c) AS DOUBLE)) AS p FROM p WHERE list_sum(c) > 0), m AS (SELECT user_id, p, [1/3.0, 1/3.0, 1/3.0] AS q FROM n),
x AS (SELECT user_id, p, q, list_transform(range(1, 4), lambda i: (p[i] + q[i]) / 2) AS h FROM m)
SELECT user_id, round(greatest(1 - 0.5 * list_sum(list_transform(range(1, 4), lambda i: CASE WHEN p[i] > 0 THEN p[i] * log2(p[i] / CASE WHEN h[i] = 0 THEN 0.0001 ELSE h[i] END) ELSE 0 END))
  - 0.5 * list_sum(list_transform(range(1, 4), lambda i: CASE WHEN q[i] > 0 THEN q[i] * log2(q[i] / CASE WHEN h[i] = 0 THEN 0.0001 ELSE h[i] END) ELSE 0 END)), 0), 5) AS similarity FROM x""")
def mt08_js_similarity(spark: SparkSession, d: str) -> DataFrame:
    kinds = ("view", "click", "signup")
    c = table(spark, d, "events").groupBy("user_id").agg(F.array(*[F.count_if(F.col("event_type") == k).cast("double") for k in kinds]).alias("c"))
    c = c.filter(F.aggregate("c", F.lit(0.0), lambda s, x: s + x) > 0)
    even = F.array(*[F.lit(1 / 3.0)] * 3)
    return c.select("user_id", F.round(vectors.js_similarity(vectors.normalised(F.col("c")), even), 5).alias("similarity"))


@query("SELECT id, coalesce(flags, 0) | 2 AS flags FROM rd_paper_reference")
def mt10_flags(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "rd_paper_reference").select("id", F.coalesce("flags", F.lit(0)).bitwiseOR(F.lit(evidence.SEARCHED)).alias("flags"))


@query("""SELECT category, count(*) AS n FROM (SELECT unnest(regexp_extract_all('<span class="nif" data-nif="' || coalesce(kind, 'none') || ',term">' || coalesce(source, '') || '</span>', '<span.+?data-nif="([^"]+)', 1)) AS category FROM documents) GROUP BY 1""")
def tx14_span_categories(spark: SparkSession, d: str) -> DataFrame:
    note = F.concat(F.lit('<span class="nif" data-nif="'), F.coalesce("kind", F.lit("none")), F.lit(',term">'), F.coalesce("source", F.lit("")), F.lit("</span>"))
    return table(spark, d, "documents").select(F.explode(text.span_categories(note)).alias("category")).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


# Pipelines


@query(f"""WITH {_KEYS}, forms AS (SELECT id, {registry_form_sql('url')} AS c FROM rd_urls WHERE batch_id = '201512' AND url IS NOT NULL), {_VARIANTS}, hit AS (SELECT DISTINCT id FROM tries JOIN keys USING (key))
SELECT c AS norm, min(id) AS url_id, count(*) AS mentions FROM forms WHERE id NOT IN (SELECT id FROM hit) GROUP BY 1""")
def pi03_candidates(spark: SparkSession, d: str, batch: str = "201512") -> DataFrame:
    u = _urls(spark, d, "id", "url", "batch_id").filter((F.col("batch_id") == batch) & F.col("url").isNotNull())
    linked = lookup.variant_lookup(u, "id", "url", lookup.registry_keys(table(spark, d, "registry"))).filter("registry_id is not null")
    new = u.join(linked.select("id"), "id", "left_anti").withColumn("norm", url.registry_form(F.col("url")))
    return new.groupBy("norm").agg(F.min("id").alias("url_id"), F.count(F.lit(1)).alias("mentions"))


@query("""WITH k AS (SELECT DISTINCT p.pubmed_id, u.registry_id FROM rd_urls u JOIN rd_paper p ON u.doc_id = p.id WHERE u.registry_id IS NOT NULL AND p.pubmed_id IS NOT NULL)
SELECT r.id, CASE WHEN k.pubmed_id IS NULL THEN coalesce(r.flags, 0) | 1 ELSE r.flags END AS flags FROM rd_paper_reference r LEFT JOIN k ON k.pubmed_id = r.pubmed_id AND k.registry_id = r.registry_id""")
def pi08_unique_flags(spark: SparkSession, d: str) -> DataFrame:
    return evidence.flag_unique(table(spark, d, "rd_paper_reference").select("id", "pubmed_id", "registry_id", "flags"), _known_by_url(spark, d)).select("id", "flags")


@query("""WITH a AS (SELECT p.pubmed_id, u.registry_id, 'u' AS src, 1.0 AS confidence FROM rd_urls u JOIN rd_paper p ON u.doc_id = p.id UNION ALL SELECT p.pubmed_id, c.registry_id, 'n', 0.8 FROM documents c JOIN rd_paper p ON p.id = c.doc_id
  UNION ALL SELECT pubmed_id, registry_id, 'p', 0.2 FROM rd_paper_reference WHERE flags & 1 = 1),
b AS (SELECT pubmed_id, registry_id, max(confidence) AS confidence, arg_max(src, confidence) AS src FROM a WHERE pubmed_id IS NOT NULL AND registry_id IS NOT NULL GROUP BY 1, 2),
l AS (SELECT p.pubmed_id, u.registry_id, min(CASE WHEN c.status = 'accepted' THEN 'good' ELSE 'bad' END) AS label FROM rd_resource_candidate c JOIN rd_urls u ON c.url_id = u.id JOIN rd_paper p ON u.doc_id = p.id WHERE c.status IN ('accepted', 'rejected') GROUP BY 1, 2)
SELECT b.pubmed_id, b.registry_id, src, CASE WHEN label = 'good' THEN 0.95 ELSE confidence END AS confidence FROM b LEFT JOIN l ON l.pubmed_id = b.pubmed_id AND l.registry_id = b.registry_id WHERE label IS NULL OR label <> 'bad'""")
def pi09_combined(spark: SparkSession, d: str) -> DataFrame:
    papers = _papers(spark, d).select("doc_id", "pubmed_id")
    u = _urls(spark, d, "doc_id", "registry_id").join(papers, "doc_id")
    n = table(spark, d, "documents").select("doc_id", "registry_id").join(papers, "doc_id")
    p = table(spark, d, "rd_paper_reference").filter("flags & 1 = 1")
    c = table(spark, d, "rd_resource_candidate").filter("status in ('accepted', 'rejected')").select("url_id", F.when(F.col("status") == "accepted", "good").otherwise("bad").alias("label"))
    labels = c.join(_urls(spark, d, F.col("id").alias("url_id"), "doc_id", "registry_id"), "url_id").join(papers, "doc_id")
    return evidence.with_labels(evidence.combine({"u": u, "n": n, "p": p}), labels)


@query("""WITH d AS (SELECT nif_id, min(id) AS ref FROM registry WHERE nif_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
SELECT d.nif_id, d.ref, arg_max(url, id) FILTER (id <> ref AND url IS NOT NULL) AS url, arg_max(description, id) FILTER (id <> ref AND description IS NOT NULL) AS description FROM d JOIN registry r ON r.nif_id = d.nif_id GROUP BY 1, 2""")
def pi11_merge(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "registry").filter("nif_id is not null").select("nif_id", "id", "url", "description")
    ref = r.groupBy("nif_id").agg(F.min("id").alias("ref"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    j = r.join(ref, "nif_id")
    last = lambda c: F.max_by(c, F.when((F.col("id") != F.col("ref")) & F.col(c).isNotNull(), F.col("id"))).alias(c)
    return j.groupBy("nif_id", "ref").agg(last("url"), last("description"))


@query("""WITH x AS (SELECT user_id, ts, event_id, event_type IN ('view', 'signup') AS up, event_type FROM events), l AS (SELECT user_id, max((ts, event_id)) AS last FROM x WHERE up GROUP BY 1),
runs AS (SELECT x.user_id, count(*) AS run FROM x LEFT JOIN l USING (user_id) WHERE NOT up AND (last IS NULL OR (ts, event_id) > last) GROUP BY 1 HAVING count(*) >= 3),
newest AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS message FROM events GROUP BY 1)
SELECT user_id, run, message, run >= 5 AS long FROM runs JOIN newest USING (user_id) WHERE NOT contains(lower(message), 'purchase')""")
def pi12_down_sites(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    runs = history.down_runs(e, "user_id", [F.col("ts"), F.col("event_id")], F.col("event_type").isin("view", "signup"))
    newest = history.latest(e, "user_id", ["ts", "event_id"], [F.col("event_type").alias("message")])
    return runs.join(newest, "user_id").filter(~F.lower("message").contains("purchase")).select("user_id", "run", "message", (F.col("run") >= 5).alias("long"))


@query(f"""WITH x AS (SELECT {host_sql('url')} AS host, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path, registry_id FROM rd_urls)
SELECT host, count(DISTINCT path) AS paths, count(*) AS urls, count(DISTINCT registry_id) AS resources FROM x WHERE host IS NOT NULL GROUP BY 1 HAVING count(*) > 10""")
def pi16_host_clusters(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("url")
    x = _urls(spark, d, url.host(u).alias("host"), url.path(u).alias("path"), "registry_id").filter("host is not null")
    small = x.groupBy("host", "path", "registry_id").agg(F.count(F.lit(1)).alias("n"))  # the map side shrinks what hot hosts send
    return small.groupBy("host").agg(F.countDistinct("path").alias("paths"), F.sum("n").alias("urls"), F.countDistinct("registry_id").alias("resources")).filter("urls > 10")


@query(f"""SELECT id, CASE WHEN regexp_matches(url, '(?i)suppl?') THEN 'supplement' WHEN split_part(host, '.', -1) = 'test' THEN 'institution' WHEN contains(host, 'repos.') THEN 'publisher' ELSE 'other' END AS kind
FROM (SELECT id, url, {host_sql('url')} AS host FROM rd_urls) WHERE host IS NOT NULL""")
def pi17_host_kinds(spark: SparkSession, d: str) -> DataFrame:
    x = _urls(spark, d, "id", "url", url.host(F.col("url")).alias("host")).filter("host is not null")
    kind = F.when(F.col("url").rlike(url.SUPPLEMENT_PATTERN), "supplement").when(url.top_level_domain(F.col("host")) == "test", "institution").when(F.col("host").contains("repos."), "publisher")
    return x.select("id", kind.otherwise("other").alias("kind"))


@query("""WITH g AS (SELECT description, bit_or(flags) AS f FROM rd_urls WHERE description IS NOT NULL AND resource_type_src = 1 GROUP BY 1)
SELECT u.id, coalesce(u.flags, 0) | g.f AS flags FROM rd_urls u JOIN g ON g.description = u.description""")
def pi18_propagate(spark: SparkSession, d: str) -> DataFrame:
    u = _urls(spark, d, "id", "flags", "resource_type_src", F.md5("description").alias("k")).filter("k is not null")
    g = u.filter("resource_type_src = 1").groupBy("k").agg(F.bit_or("flags").alias("f")).filter("f is not null")
    return u.join(g, "k").select("id", F.coalesce("flags", F.lit(0)).bitwiseOR(F.col("f")).alias("flags"))


@query("""SELECT r.id, coalesce(nullif(r.supercategory, ''), s.supercategory) AS supercategory FROM registry r LEFT JOIN (SELECT nif_id, max(supercategory) AS supercategory FROM registry WHERE supercategory <> '' GROUP BY 1) s ON s.nif_id = r.nif_id""")
def pi22_backfill(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "registry").select("id", "nif_id", "supercategory")
    s = r.filter("supercategory <> '' and nif_id is not null").groupBy("nif_id").agg(F.max("supercategory").alias("_s"))
    return r.join(s, "nif_id", "left").select("id", F.coalesce(F.nullif("supercategory", F.lit("")), "_s").alias("supercategory"))


@query("""WITH m AS (SELECT r.id AS old_id, k.kept AS new_id FROM registry r JOIN (SELECT nif_id, max(id) AS kept FROM registry WHERE nif_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1) k USING (nif_id) WHERE r.id <> k.kept)
SELECT u.id, coalesce(m.new_id, u.registry_id) AS registry_id FROM rd_urls u LEFT JOIN m ON m.old_id = u.registry_id""")
def pi23_repoint(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "registry").filter("nif_id is not null").select("id", "nif_id")
    kept = r.groupBy("nif_id").agg(F.max("id").alias("new_id"))
    mapping = r.join(kept, "nif_id").filter("id <> new_id").select(F.col("id").alias("old_id"), "new_id")
    return lookup.repoint(_urls(spark, d, "id", "registry_id"), "registry_id", mapping).select("id", "registry_id")


@query("""WITH c AS (SELECT id, score FROM rd_urls WHERE batch_id = '201512' AND NOT isnan(score)), t AS (SELECT id, c_score AS score FROM rd_urls WHERE batch_id <> '201506' OR batch_id IS NULL)
SELECT coalesce(c.id, t.id) AS id, CASE WHEN c.id IS NOT NULL THEN c.score ELSE t.score END AS score FROM t FULL JOIN c ON c.id = t.id""")
def sk04_upsert(spark: SparkSession, d: str, batch: str = "201512", dropped: str = "201506") -> DataFrame:
    u = _urls(spark, d, "id", "score", "c_score", "batch_id")
    changes = u.filter((F.col("batch_id") == batch) & F.col("score").isNotNull() & ~F.isnan("score")).select("id", "score")
    return lookup.upsert(u.filter((F.col("batch_id") != dropped) | F.col("batch_id").isNull()).select("id", F.col("c_score").alias("score")), changes, ["id"], ["score"])


QUERIES = Q

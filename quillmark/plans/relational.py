"""Joins, aggregates, windows, sorts and sets over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmark.functions import text, url
from quillmark.operators import evidence, history, lookup
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


def _urls(spark, d, *cols):
    return table(spark, d, "rd_urls").select(*(cols or "*"))


def _papers(spark, d):
    return table(spark, d, "rd_paper").select(F.col("id").alias("doc_id"), "pubmed_id", "title")


def _registry(spark, d):
    return table(spark, d, "registry").select(F.col("id").alias("registry_id"), "nif_id", "resource_name")


# Joins


@query("""SELECT u.id, p.pubmed_id, r.nif_id FROM rd_urls u JOIN rd_paper p ON u.doc_id = p.id JOIN registry r ON u.registry_id = r.id""")
def jo01_evidence(spark: SparkSession, d: str) -> DataFrame:
    return _urls(spark, d, "id", "doc_id", "registry_id").join(_papers(spark, d), "doc_id").join(_registry(spark, d), "registry_id").select("id", "pubmed_id", "nif_id")


@query("""SELECT c.id, c.status, r.nif_id, p.pubmed_id FROM rd_resource_candidate c JOIN rd_urls u ON c.url_id = u.id JOIN registry r ON u.registry_id = r.id JOIN rd_paper p ON u.doc_id = p.id""")
def jo02_labelled_evidence(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "rd_resource_candidate").select("id", "status", "url_id")
    u = _urls(spark, d, F.col("id").alias("url_id"), "doc_id", "registry_id")
    return c.join(u, "url_id").join(_registry(spark, d), "registry_id").join(_papers(spark, d), "doc_id").select("id", "status", "nif_id", "pubmed_id")


@query("SELECT DISTINCT p.pubmed_id, u.registry_id FROM rd_urls u JOIN rd_paper p ON u.doc_id = p.id WHERE u.registry_id IS NOT NULL")
def jo03_known_pairs(spark: SparkSession, d: str) -> DataFrame:
    return _known_by_url(spark, d)


def _known_by_url(spark, d):
    u = _urls(spark, d, "doc_id", "registry_id").filter("registry_id is not null").distinct()
    return u.join(_papers(spark, d), "doc_id").select("pubmed_id", "registry_id").distinct()


@query("SELECT p.id AS doc_id, count(u.id) AS mentions FROM rd_paper p LEFT JOIN rd_urls u ON u.doc_id = p.id GROUP BY 1")
def jo04_paper_mentions(spark: SparkSession, d: str) -> DataFrame:
    n = _urls(spark, d, "doc_id", "id").groupBy("doc_id").agg(F.count("id").alias("n"))
    return _papers(spark, d).select("doc_id").join(n, "doc_id", "left").select("doc_id", F.coalesce("n", F.lit(0)).alias("mentions"))


@query("SELECT c.id, u.url FROM rd_resource_candidate c JOIN rd_urls u ON c.url_id = u.id")
def jo05_candidate_urls(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "rd_resource_candidate").select("id", "url_id")
    return c.join(_urls(spark, d, F.col("id").alias("url_id"), "url"), "url_id").select("id", "url")


_KEYS = f"""keys AS (SELECT key, max(id) AS registry_id FROM (
  SELECT id, {registry_form_sql('url')} AS key FROM registry WHERE url IS NOT NULL UNION ALL SELECT id, {registry_form_sql('old_url')} FROM registry WHERE old_url IS NOT NULL
  UNION ALL SELECT id, {registry_form_sql('u')} FROM (SELECT id, unnest(regexp_split_to_array(regexp_replace(alt_url, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g'), '\\s*,\\s*')) AS u FROM registry WHERE alt_url IS NOT NULL))
  WHERE key <> 'http://' GROUP BY key)"""
_VARIANTS = f"""tries AS (SELECT id, 0 AS priority, c AS key FROM forms UNION ALL
  SELECT id, 1, 'http://' || substr(c, 12) FROM forms WHERE c LIKE 'http://www.%' UNION ALL
  SELECT id, 2, 'http://www.' || substr(c, 8) FROM forms WHERE c NOT LIKE 'http://www.%' AND length(c) - length(replace(c, '.', '')) = 1 UNION ALL
  SELECT id, 3, c || '/index.html' FROM forms WHERE c NOT LIKE '%/index.html')"""


@query(f"""WITH {_KEYS}, forms AS (SELECT id, {registry_form_sql('url')} AS c FROM rd_urls WHERE url IS NOT NULL), {_VARIANTS},
best AS (SELECT id, arg_max(tries.key, priority) AS variant, arg_max(registry_id, priority) AS registry_id FROM tries JOIN keys USING (key) GROUP BY id)
SELECT u.id, variant, best.registry_id FROM rd_urls u LEFT JOIN best USING (id)""")
def jo06_variant_lookup(spark: SparkSession, d: str) -> DataFrame:
    return lookup.variant_lookup(_urls(spark, d, "id", "url"), "id", "url", lookup.registry_keys(table(spark, d, "registry")))


@query(f"""WITH {_KEYS}, forms AS (SELECT id, {registry_form_sql('url')} AS c FROM rd_urls WHERE url IS NOT NULL AND registry_id IS NULL), {_VARIANTS}
SELECT id, arg_max(registry_id, priority) AS registry_id FROM tries JOIN keys USING (key) GROUP BY id""")
def jo07_relink(spark: SparkSession, d: str) -> DataFrame:
    rows = _urls(spark, d, "id", "url", "registry_id").filter("registry_id is null").select("id", "url")
    return lookup.variant_lookup(rows, "id", "url", lookup.registry_keys(table(spark, d, "registry"))).filter("registry_id is not null").select("id", "registry_id")


@query(f"WITH {_KEYS} SELECT key, registry_id FROM keys")
def jo08_registry_keys(spark: SparkSession, d: str) -> DataFrame:
    return lookup.registry_keys(table(spark, d, "registry"))


@query("""WITH e AS (SELECT DISTINCT abbrev AS entity, lower(abbrev) AS le FROM registry WHERE abbrev <> ''), n AS (SELECT lower(resource_name) AS ln, id AS key FROM registry WHERE resource_name IS NOT NULL),
h AS (SELECT DISTINCT entity, key FROM (SELECT *, instr(ln, le) AS p FROM e JOIN n ON contains(ln, le))
  WHERE (p = 1 OR regexp_matches(substr(ln, p - 1, 1), '\\s')) AND (substr(ln, p + length(le), 1) = '' OR regexp_matches(substr(ln, p + length(le), 1), '[\\s0-9]')))
SELECT entity, min(key) AS key FROM h GROUP BY entity HAVING count(*) = 1""")
def jo09_unique_containment(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "registry")
    return lookup.unique_containment(r.select("abbrev"), "abbrev", r.select("resource_name", "id"), "resource_name", "id")


@query("SELECT id, pubmed_id FROM rd_paper_reference WHERE pubmed_id IN (SELECT pubmed_id FROM rd_paper)")
def jo10_known_papers(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "rd_paper_reference").select("id", "pubmed_id").join(_papers(spark, d).select("pubmed_id"), "pubmed_id", "left_semi")


@query("""SELECT id FROM rd_paper_reference r WHERE EXISTS (SELECT 1 FROM rd_urls u JOIN rd_paper p ON u.doc_id = p.id WHERE p.pubmed_id = r.pubmed_id AND u.registry_id = r.registry_id)""")
def jo11_already_linked(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "rd_paper_reference").select("id", "pubmed_id", "registry_id").join(_known_by_url(spark, d), ["pubmed_id", "registry_id"], "left_semi").select("id")


@query("SELECT id, file_path FROM rd_paper p WHERE NOT EXISTS (SELECT 1 FROM rd_urls u WHERE u.doc_id = p.id)")
def jo12_unprocessed(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "rd_paper").select("id", "file_path").join(_urls(spark, d, F.col("doc_id").alias("id")), "id", "left_anti")


@query("""SELECT id FROM rd_paper_reference r WHERE NOT EXISTS (SELECT 1 FROM rd_urls u JOIN rd_paper p ON u.doc_id = p.id WHERE p.pubmed_id = r.pubmed_id AND u.registry_id = r.registry_id)""")
def jo13_new_pairs(spark: SparkSession, d: str) -> DataFrame:
    return evidence.new_pairs(table(spark, d, "rd_paper_reference").select("id", "pubmed_id", "registry_id"), [_known_by_url(spark, d)]).select("id")


@query("""SELECT id, min(id) OVER (PARTITION BY description) AS first_id, count(*) OVER (PARTITION BY description) - 1 AS others FROM rd_urls WHERE description IS NOT NULL
QUALIFY count(*) OVER (PARTITION BY description) > 1""")
def jo16_same_description(spark: SparkSession, d: str) -> DataFrame:
    u = _urls(spark, d, "id", F.md5("description").alias("k")).filter("k is not null")
    g = u.groupBy("k").agg(F.min("id").alias("first_id"), (F.count(F.lit(1)) - 1).alias("others")).filter("others > 0")
    return u.join(g, "k").select("id", "first_id", "others")


@query(f"""WITH h AS (SELECT {host_sql('url')} AS host, min(id) AS r FROM registry GROUP BY 1), p AS (SELECT regexp_extract(url, '^[^?#]*') AS page, min(id) AS r FROM registry WHERE url IS NOT NULL GROUP BY 1)
SELECT u.id, coalesce(p.r, h.r) AS registry_id FROM rd_urls u LEFT JOIN h ON h.host = {host_sql('u.url')} LEFT JOIN p ON p.page = regexp_extract(u.url, '^[^?#]*')""")
def jo17_curated(spark: SparkSession, d: str) -> DataFrame:
    u, r = F.col("url"), table(spark, d, "registry").filter("url is not null")
    hosts = r.groupBy(url.host(u).alias("host")).agg(F.min("id").alias("registry_id")).filter("host is not null")
    pages = r.groupBy(url.base(u).alias("page")).agg(F.min("id").alias("registry_id"))
    return lookup.curated(_urls(spark, d, "id", url.host(u).alias("host"), url.base(u).alias("page")), hosts, pages)


@query(f"""WITH h AS (SELECT regexp_replace({host_sql('url')}, '^www\\.', '') AS host, min(id) AS registry_id FROM registry GROUP BY 1)
SELECT u.id, host, h.registry_id FROM (SELECT id, regexp_replace({host_sql('url')}, '^www\\.', '') AS host FROM rd_urls) u JOIN h USING (host)""")
def jo18_host_lookup(spark: SparkSession, d: str) -> DataFrame:
    return lookup.host_lookup(_urls(spark, d, "id", "url"), "id", "url", table(spark, d, "registry"))


@query("""WITH s AS (SELECT id, resource_name, description FROM registry WHERE curation_status = 'Curated'), t AS (SELECT id, resource_name, description FROM registry WHERE date_updated < 1400000000)
SELECT coalesce(s.id, t.id) AS id, CASE WHEN t.id IS NULL THEN 'insert' WHEN s.id IS NULL THEN 'missing'
  WHEN s.resource_name IS NOT DISTINCT FROM t.resource_name AND s.description IS NOT DISTINCT FROM t.description THEN 'keep' ELSE 'update' END AS action,
  coalesce(s.resource_name, t.resource_name) AS resource_name, coalesce(s.description, t.description) AS description FROM s FULL JOIN t ON s.id = t.id""")
def jo19_sync(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "registry")
    return lookup.sync(r.filter("curation_status = 'Curated'"), r.filter("date_updated < 1400000000"), "id", ["resource_name", "description"])


# Filters


@query("SELECT id, nif_id FROM registry WHERE availability IS NULL OR NOT contains(availability, 'THIS RESOURCE IS NO LONGER IN SERVICE')")
def fl02_active(spark: SparkSession, d: str) -> DataFrame:
    gone = F.col("availability").contains("THIS RESOURCE IS NO LONGER IN SERVICE")
    return table(spark, d, "registry").filter(~F.coalesce(gone, F.lit(False))).select("id", "nif_id")


@query("SELECT batch_id, count(*) AS n FROM rd_urls WHERE (batch_id = '201406' OR batch_id = '201407') AND flags = 0 GROUP BY 1")
def fl03_batches(spark: SparkSession, d: str) -> DataFrame:
    return _urls(spark, d, "batch_id", "flags").filter("batch_id in ('201406', '201407') and flags = 0").groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT id, c_score FROM rd_urls WHERE c_score > 0.5 AND c_score <= 0.75")
def fl04_half_open(spark: SparkSession, d: str) -> DataFrame:
    return _urls(spark, d, "id", "c_score").filter("c_score > 0.5 and c_score <= 0.75")


@query("SELECT id, publisher_id, registry_id FROM rd_publisher_query_log WHERE exec_time >= TIMESTAMP '2014-06-01 00:00:00'")
def fl05_since(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "rd_publisher_query_log").filter("exec_time >= timestamp_ntz'2014-06-01 00:00:00'").select("id", "publisher_id", "registry_id")


@query("SELECT id, score FROM rd_urls WHERE score > 0 AND NOT isnan(score) UNION ALL SELECT id, score FROM rd_urls WHERE score IS NULL")
def fl06_scored_or_open(spark: SparkSession, d: str) -> DataFrame:
    return _urls(spark, d, "id", "score").filter("(score > 0 and not isnan(score)) or score is null")


@query("SELECT doc_id, source FROM documents WHERE length(text) = 0")
def fl07_empty(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").filter("length(text) = 0").select("doc_id", "source")


@query("""SELECT id, contains(url, 'www.w3.org') OR contains(url, 'creativecommons') OR contains(url, 'dx.doi') OR contains(url, 'www.elsevier.com')
  OR regexp_matches(url, '(?i)zip|rar|gz|jpg|jpeg|gif|bz2|pdf') OR starts_with(url, 'mail') OR NOT regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.-]*:.+') AS bad FROM rd_urls""")
def fl11_bad_urls(spark: SparkSession, d: str) -> DataFrame:
    return _urls(spark, d, "id", url.is_bad(F.col("url")).alias("bad"))


@query("""SELECT id, abbrev, length(abbrev) <= 3 OR regexp_matches(abbrev, '^[0-9.]*$') OR abbrev IN ('program','programs','code','libraries','interface','using','Biomedical') AS noise FROM registry""")
def fl13_noise(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "registry").select("id", "abbrev", text.is_noise(F.col("abbrev")).alias("noise"))


@query(f"""SELECT id FROM (SELECT id, {host_sql('url')} AS host, regexp_extract(url, '^[^?#]*\\?([^#]*)', 1) AS q FROM rd_urls)
QUALIFY q = '' OR row_number() OVER (PARTITION BY host ORDER BY id) <= 5""")
def fl16_query_cap(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("url")
    x = _urls(spark, d, "id", url.host(u).alias("host"), url.query(u).alias("q"))
    return history.capped(x, "host", F.col("q").isNull(), ["id"], 5).select("id")


@query("SELECT id, regexp_matches(lower(trim(title)), '^techniques$|method|procedure|experiment') AS methods FROM rd_paper")
def fl17_sections(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "rd_paper").select("id", text.eligible_section(F.col("title")).alias("methods"))


@query("""SELECT r.id FROM rd_paper_reference r JOIN registry g ON r.registry_id = g.id WHERE coalesce(len(list_filter(string_split(r.authors, ';'), lambda a: contains(lower(a), lower(g.abbrev)))) > 0, false)""")
def fl20_author_is_term(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "rd_paper_reference").select("id", "registry_id", "authors")
    g = table(spark, d, "registry").select(F.col("id").alias("registry_id"), "abbrev")
    hit = F.exists(F.split("authors", ";"), lambda a: F.lower(a).contains(F.lower(F.col("abbrev"))))
    return r.join(g, "registry_id").filter(F.coalesce(hit, F.lit(False))).select("id")


# Aggregates


@query("SELECT nif_id, count(*) AS n FROM registry WHERE nif_id IS NOT NULL GROUP BY nif_id HAVING count(*) > 1")
def ag01_duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "registry").filter("nif_id is not null").groupBy("nif_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


@query("SELECT max(id) AS checkpoint FROM rd_paper_reference")
def ag02_checkpoint(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "rd_paper_reference").agg(F.max("id").alias("checkpoint"))


@query(f"SELECT id, host, count(*) OVER (PARTITION BY host) AS host_link_size FROM (SELECT id, {host_sql('url')} AS host FROM rd_urls) WHERE host IS NOT NULL")
def ag03_host_link_size(spark: SparkSession, d: str) -> DataFrame:
    x = _urls(spark, d, "id", url.host(F.col("url")).alias("host")).filter("host is not null")
    return x.join(x.groupBy("host").agg(F.count(F.lit(1)).alias("host_link_size")), "host").select("id", "host", "host_link_size")


@query("SELECT resource_type, count(*) AS n FROM rd_urls GROUP BY 1")
def ag04_frequencies(spark: SparkSession, d: str) -> DataFrame:
    return _urls(spark, d, "resource_type").groupBy("resource_type").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT DISTINCT batch_id FROM rd_urls")
def ag05_batches(spark: SparkSession, d: str) -> DataFrame:
    return _urls(spark, d, "batch_id").distinct()


@query("""SELECT registry_id, count(*) AS n, min(c_score) AS lo, max(c_score) AS hi, round(sum(c_score), 6) AS total FROM rd_urls
WHERE registry_id IS NOT NULL AND NOT isnan(c_score) GROUP BY 1""")
def ag08_score_range(spark: SparkSession, d: str) -> DataFrame:
    x = _urls(spark, d, "registry_id", "c_score").filter("registry_id is not null and c_score is not null and not isnan(c_score)")
    return x.groupBy("registry_id").agg(F.count(F.lit(1)).alias("n"), F.min("c_score").alias("lo"), F.max("c_score").alias("hi"), F.round(F.sum("c_score"), 6).alias("total"))


@query(f"""SELECT host, path, count(*) AS urls, count(DISTINCT path) AS paths FROM (SELECT {host_sql('url')} AS host, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path FROM rd_urls)
WHERE host IS NOT NULL GROUP BY ROLLUP (host, path)""")
def ag09_host_paths(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("url")
    x = _urls(spark, d, url.host(u).alias("host"), url.path(u).alias("path")).filter("host is not null")
    pages = x.groupBy("host", "path").agg(F.count(F.lit(1)).alias("urls"), F.lit(1).cast("long").alias("paths"))
    hosts = pages.groupBy("host").agg(F.sum("urls").alias("urls"), F.sum("paths").alias("paths")).select("host", F.lit(None).cast("string").alias("path"), "urls", "paths")
    # The paths of all hosts together are counted from the per-host rows, so the raw rows are shuffled once.
    total = pages.groupBy("path").agg(F.sum("urls").alias("urls")).agg(F.sum("urls").alias("urls"), F.count(F.lit(1)).alias("paths"))
    total = total.filter("urls is not null").select(F.lit(None).cast("string").alias("host"), F.lit(None).cast("string").alias("path"), "urls", "paths")
    return pages.unionByName(hosts).unionByName(total)


@query("""SELECT g.id, coalesce(nullif(u.n, 0), nullif(c.n, 0), nullif(r.n, 0), 0) AS mentions FROM registry g LEFT JOIN (SELECT registry_id, count(*) AS n FROM rd_urls GROUP BY 1) u ON u.registry_id = g.id
LEFT JOIN (SELECT registry_id, count(*) AS n FROM documents GROUP BY 1) c ON c.registry_id = g.id LEFT JOIN (SELECT registry_id, count(*) AS n FROM rd_paper_reference GROUP BY 1) r ON r.registry_id = g.id""")
def ag10_mentions(spark: SparkSession, d: str) -> DataFrame:
    out = table(spark, d, "registry").select("id")
    for k, t in enumerate(("rd_urls", "documents", "rd_paper_reference")):
        n = table(spark, d, t).filter("registry_id is not null").groupBy(F.col("registry_id").alias("id")).agg(F.count(F.lit(1)).alias(f"n{k}"))
        out = out.join(n, "id", "left")
    return out.select("id", F.coalesce("n0", "n1", "n2", F.lit(0)).alias("mentions"))


@query("""SELECT publisher_id, round(avg(c_score), 6) AS mean, round(var_samp(c_score), 6) AS variance, round(stddev_samp(c_score), 6) AS sd FROM rd_paper_reference WHERE NOT isnan(c_score) GROUP BY 1""")
def ag11_mean_variance(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "rd_paper_reference").filter("not isnan(c_score)")
    r = lambda c, a: F.round(c, 6).alias(a)
    return x.groupBy("publisher_id").agg(r(F.avg("c_score"), "mean"), r(F.var_samp("c_score"), "variance"), r(F.stddev_samp("c_score"), "sd"))


@query("SELECT round(count(*) / CAST(count(DISTINCT doc_id) AS DOUBLE), 6) AS per_paper FROM rd_urls WHERE doc_id IS NOT NULL")
def ag12_per_paper(spark: SparkSession, d: str) -> DataFrame:
    n = _urls(spark, d, "doc_id").filter("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    return n.agg(F.round(F.sum("n") / F.count(F.lit(1)).cast("double"), 6).alias("per_paper"))


@query("""SELECT pubmed_id, array_to_string(list_sort(list(DISTINCT registry_id)), ',') AS registry_ids FROM rd_paper_reference WHERE pubmed_id IS NOT NULL AND registry_id IS NOT NULL GROUP BY 1""")
def ag13_pair_sets(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "rd_paper_reference").filter("pubmed_id is not null and registry_id is not null").select("pubmed_id", "registry_id").distinct()
    return x.groupBy("pubmed_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("registry_id")), lambda x: x.cast("string")), ",").alias("registry_ids"))


@query("""WITH t AS (SELECT batch_id, status = 'accepted' AS truth, score >= 3 AND NOT isnan(score) AS guess FROM rd_resource_candidate WHERE status IN ('accepted', 'rejected') AND score IS NOT NULL),
n AS (SELECT batch_id, count(*) FILTER (truth AND guess) AS tp, count(*) FILTER (NOT truth AND guess) AS fp, count(*) FILTER (truth AND NOT guess) AS fn FROM t GROUP BY 1),
q AS (SELECT *, tp / CAST(nullif(tp + fp, 0) AS DOUBLE) AS precision, tp / CAST(nullif(tp + fn, 0) AS DOUBLE) AS recall, 2.0 * tp / nullif(2 * tp + fp + fn, 0) AS f1 FROM n)
SELECT batch_id, tp, fp, fn, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM q
UNION ALL SELECT 'all', CAST(sum(tp) AS BIGINT), CAST(sum(fp) AS BIGINT), CAST(sum(fn) AS BIGINT), round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6) FROM q""")
def ag15_precision_recall(spark: SparkSession, d: str) -> DataFrame:
    """How well a score tells accepted submissions from rejected ones, batch by batch, and the macro average of these."""
    c = table(spark, d, "rd_resource_candidate").filter("status in ('accepted', 'rejected') and score is not null")
    t = c.select("batch_id", (F.col("status") == "accepted").alias("truth"), ((F.col("score") >= 3) & ~F.isnan("score")).alias("guess"))
    n = t.groupBy("batch_id").agg(F.count_if(F.expr("truth and guess")).alias("tp"), F.count_if(F.expr("not truth and guess")).alias("fp"), F.count_if(F.expr("truth and not guess")).alias("fn"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    q = n.select("batch_id", "tp", "fp", "fn", F.try_divide(tp, tp + fp).alias("precision"), F.try_divide(tp, tp + fn).alias("recall"), F.try_divide(2.0 * tp, 2 * tp + fp + fn).alias("f1"))
    counts, parts = ["tp", "fp", "fn"], ["precision", "recall", "f1"]
    macro = q.agg(*[F.sum(k).alias(k) for k in counts], *[F.avg(k).alias(k) for k in parts]).select(F.lit("all").alias("batch_id"), *counts, *parts)
    return q.unionByName(macro).select("batch_id", *counts, *[F.round(k, 6).alias(k) for k in parts])


@query(f"SELECT split_part(host, '.', -1) AS tld, count(*) AS n FROM (SELECT {host_sql('url')} AS host FROM rd_urls) WHERE contains(host, '.') GROUP BY 1")
def ag17_top_level_domains(spark: SparkSession, d: str) -> DataFrame:
    x = _urls(spark, d, url.host(F.col("url")).alias("host")).select(url.top_level_domain(F.col("host")).alias("tld")).filter("tld is not null")
    return x.groupBy("tld").agg(F.count(F.lit(1)).alias("n"))


# Windows in disguise: histories


@query("""WITH x AS (SELECT user_id, ts, event_id, event_type IN ('view', 'signup') AS up FROM events), l AS (SELECT user_id, max((ts, event_id)) AS last FROM x WHERE up GROUP BY 1)
SELECT x.user_id, count(*) AS run FROM x LEFT JOIN l USING (user_id) WHERE NOT up AND (last IS NULL OR (ts, event_id) > last) GROUP BY 1 HAVING count(*) >= 3""")
def wi01_down_runs(spark: SparkSession, d: str) -> DataFrame:
    return history.down_runs(table(spark, d, "events"), "user_id", [F.col("ts"), F.col("event_id")], F.col("event_type").isin("view", "signup"))


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, max(ts) AS ts FROM events GROUP BY 1")
def wi02_latest_status(spark: SparkSession, d: str) -> DataFrame:
    return history.latest(table(spark, d, "events"), "user_id", ["ts", "event_id"], ["event_type", "ts"])


@query("""SELECT id FROM rd_paper_reference WHERE registry_id IS NOT NULL AND pubmed_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY registry_id, pubmed_id ORDER BY id) > 1""")
def wi03_later_copies(spark: SparkSession, d: str) -> DataFrame:
    return history.later_copies(table(spark, d, "rd_paper_reference").select("id", "registry_id", "pubmed_id"), ["registry_id", "pubmed_id"], "id").select("id")


@query("""SELECT doc_id, url, arg_min(id, (batch_id, id)) AS id, min(batch_id) AS batch_id FROM rd_urls WHERE doc_id IS NOT NULL GROUP BY 1, 2""")
def wi04_oldest_batch(spark: SparkSession, d: str) -> DataFrame:
    return history.first_of(_urls(spark, d, "id", "doc_id", "url", "batch_id").filter("doc_id is not null"), ["doc_id", "url"], ["batch_id", "id"], ["id", "batch_id"])


@query(f"SELECT batch_id, {registry_form_sql('url')} AS norm, min(id) AS id FROM rd_urls GROUP BY 1, 2")
def wi05_first_seen(spark: SparkSession, d: str) -> DataFrame:
    return _urls(spark, d, "id", "batch_id", url.registry_form(F.col("url")).alias("norm")).groupBy("batch_id", "norm").agg(F.min("id").alias("id"))


@query("SELECT nif_id, max(id) AS kept, count(*) - 1 AS dropped FROM registry WHERE nif_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def wi07_newest_survives(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "registry").filter("nif_id is not null").groupBy("nif_id").agg(F.max("id").alias("kept"), (F.count(F.lit(1)) - 1).alias("dropped"))
    return x.filter("dropped > 0")


@query(f"SELECT id, row_number() OVER (PARTITION BY host ORDER BY id) AS turn FROM (SELECT c.id, {host_sql('u.url')} AS host FROM rd_resource_candidate c JOIN rd_urls u ON c.url_id = u.id)")
def wi08_round_robin(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "rd_resource_candidate").select("id", "url_id").join(_urls(spark, d, F.col("id").alias("url_id"), "url"), "url_id")
    return history.round_robin(c.select("id", url.host(F.col("url")).alias("host")), "host", "id").select("id", "turn")


@query("SELECT id, lag(query_str) OVER (PARTITION BY publisher_id ORDER BY exec_time, id) AS before FROM rd_publisher_query_log")
def wi09_previous_query(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("publisher_id").orderBy("exec_time", "id")
    return table(spark, d, "rd_publisher_query_log").select("id", F.lag("query_str").over(w).alias("before"))


@query("""WITH s AS (SELECT registry_id, max(exec_time) AS t FROM rd_publisher_query_log WHERE exec_time >= TIMESTAMP '2015-06-01' AND registry_id IS NOT NULL GROUP BY 1)
SELECT id FROM registry WHERE id IN (SELECT registry_id FROM s WHERE (t, registry_id) < (SELECT max((t, registry_id)) FROM s))""")
def wi10_resume(spark: SparkSession, d: str) -> DataFrame:
    log = table(spark, d, "rd_publisher_query_log").filter("exec_time >= timestamp_ntz'2015-06-01 00:00:00' and registry_id is not null")
    seen = log.select(F.col("registry_id").alias("id"), "exec_time")
    return history.resume_prefix(table(spark, d, "registry").select("id"), "id", seen, "id", "exec_time")


@query("""SELECT id, arg_min(alive, id) OVER (PARTITION BY base) AS alive, CASE WHEN id = min(id) OVER (PARTITION BY base) THEN 1 ELSE 2 END AS flags
FROM (SELECT id, regexp_extract(url, '^[^?#]*') AS base, coalesce(score, -1) <> -1 AS alive FROM rd_urls)""")
def wi11_inferred(spark: SparkSession, d: str) -> DataFrame:
    x = _urls(spark, d, "id", url.base(F.col("url")).alias("base"), (F.coalesce("score", F.lit(-1.0)) != -1).alias("alive"))
    return history.inferred(x, "base", "id", "alive").select("id", "alive", "flags")


# Sorts and limits


@query("SELECT id, query_str FROM rd_publisher_query_log ORDER BY exec_time DESC, id DESC LIMIT 1")
def so02_latest_log(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "rd_publisher_query_log").orderBy(F.desc("exec_time"), F.desc("id")).limit(1).select("id", "query_str")


@query(f"""SELECT host, path, n FROM (SELECT {host_sql('url')} AS host, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path, count(*) AS n FROM rd_urls GROUP BY 1, 2)
WHERE host IS NOT NULL QUALIFY row_number() OVER (PARTITION BY host ORDER BY n DESC, path) <= 11""")
def so05_top_paths(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("url")
    n = _urls(spark, d, url.host(u).alias("host"), url.path(u).alias("path")).filter("host is not null").groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("host").orderBy(F.desc("n"), "path")
    return n.withColumn("k", F.row_number().over(w)).filter("k <= 11").drop("k")


@query("""SELECT doc_id, arg_max(registry_id, (n, -registry_id)) AS registry_id FROM (SELECT doc_id, registry_id, count(*) AS n FROM rd_urls WHERE doc_id IS NOT NULL AND registry_id IS NOT NULL GROUP BY 1, 2) GROUP BY 1""")
def so06_most_frequent(spark: SparkSession, d: str) -> DataFrame:
    n = _urls(spark, d, "doc_id", "registry_id").na.drop().groupBy("doc_id", "registry_id").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy("doc_id").agg(F.max_by("registry_id", F.struct("n", -F.col("registry_id"))).alias("registry_id"))


@query(f"SELECT {host_sql('url')} AS host, count(*) AS n FROM rd_urls GROUP BY 1 HAVING count(*) >= 100 AND host IS NOT NULL")
def so08_large_hosts(spark: SparkSession, d: str) -> DataFrame:
    x = _urls(spark, d, url.host(F.col("url")).alias("host")).filter("host is not null")
    return x.groupBy("host").agg(F.count(F.lit(1)).alias("n")).filter("n >= 100")


@query(f"""WITH x AS (SELECT id, {host_sql('url')} AS host, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path FROM rd_urls), p AS (SELECT host, count(DISTINCT path) AS paths FROM x WHERE host IS NOT NULL GROUP BY 1),
y AS (SELECT id, x.host, row_number() OVER (PARTITION BY x.host, path ORDER BY id) AS k, greatest(round(100.0 / paths), 1) AS quota FROM x JOIN p ON x.host = p.host)
SELECT id FROM (SELECT id, host, k FROM y WHERE k <= quota) QUALIFY row_number() OVER (PARTITION BY host ORDER BY k, id) <= 100""")
def so10_path_quota(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("url")
    x = _urls(spark, d, "id", url.host(u).alias("host"), url.path(u).alias("path")).filter("host is not null")
    quota = x.select("host", "path").distinct().groupBy("host").agg(F.greatest(F.round(100.0 / F.count(F.lit(1))), F.lit(1.0)).alias("quota"))
    y = x.withColumn("k", F.row_number().over(Window.partitionBy("host", "path").orderBy("id"))).join(quota, "host").filter("k <= quota")
    return y.withColumn("m", F.row_number().over(Window.partitionBy("host").orderBy("k", "id"))).filter("m <= 100").select("id")


# Sets


@query("""SELECT p.pubmed_id, u.registry_id, 'u' AS src FROM rd_urls u JOIN rd_paper p ON u.doc_id = p.id UNION ALL SELECT pubmed_id, registry_id, 'p' FROM rd_paper_reference WHERE flags & 1 = 1""")
def se01_evidence_union(spark: SparkSession, d: str) -> DataFrame:
    u = _urls(spark, d, "doc_id", "registry_id").join(_papers(spark, d), "doc_id").select("pubmed_id", "registry_id", F.lit("u").alias("src"))
    p = table(spark, d, "rd_paper_reference").filter("flags & 1 = 1").select("pubmed_id", "registry_id", F.lit("p").alias("src"))
    return u.unionByName(p)


@query("SELECT pubmed_id FROM rd_paper WHERE pubmed_id IS NOT NULL UNION SELECT pubmed_id FROM rd_paper_reference WHERE pubmed_id IS NOT NULL")
def se02_seen(spark: SparkSession, d: str) -> DataFrame:
    a, b = (table(spark, d, t).select("pubmed_id").filter("pubmed_id is not null") for t in ("rd_paper", "rd_paper_reference"))
    return a.union(b).distinct()


@query("SELECT id FROM rd_urls WHERE id NOT IN (SELECT url_id FROM rd_resource_candidate WHERE url_id IS NOT NULL)")
def se03_difference(spark: SparkSession, d: str) -> DataFrame:
    return _urls(spark, d, "id").join(table(spark, d, "rd_resource_candidate").select(F.col("url_id").alias("id")), "id", "left_anti")


@query("""WITH a AS (SELECT DISTINCT registry_id FROM rd_urls WHERE registry_id IS NOT NULL), b AS (SELECT DISTINCT registry_id FROM rd_paper_reference WHERE registry_id IS NOT NULL)
SELECT (SELECT count(*) FROM a JOIN b USING (registry_id)) AS both, (SELECT count(*) FROM (SELECT * FROM a UNION SELECT * FROM b)) AS either""")
def se04_cardinalities(spark: SparkSession, d: str) -> DataFrame:
    parts = [table(spark, d, t).select("registry_id", F.lit(k).alias("k")).filter("registry_id is not null").distinct() for k, t in ((1, "rd_urls"), (2, "rd_paper_reference"))]
    n = parts[0].union(parts[1]).groupBy("registry_id").agg(F.sum("k").alias("k"))
    return n.agg(F.count_if(F.col("k") == 3).alias("both"), F.count(F.lit(1)).alias("either"))


QUERIES = Q

"""Scalar functions over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.functions import dates, text, url
from quillmark.runtime import table

Q, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


#: SQL of an address in registry form.
def bare_sql(c: str) -> str:
    return f"regexp_replace({c}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"


def registry_form_sql(c: str) -> str:
    s = f"regexp_replace(lower({bare_sql(c)}), '/$', '')"
    return f"(CASE WHEN {s} LIKE 'http%' THEN {s} ELSE 'http://' || {s} END)"


def host_sql(c: str) -> str:
    return f"nullif(lower(regexp_extract({c}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)', 1)), '')"


@query(f"SELECT id, {registry_form_sql('url')} AS norm FROM registry WHERE url IS NOT NULL")
def st01_registry_form(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "registry").filter("url is not null").select("id", url.registry_form(F.col("url")).alias("norm"))


@query(f"""SELECT id, {registry_form_sql('u')} AS norm FROM (
  SELECT id, unnest(regexp_split_to_array({bare_sql('alt_url')}, '\\s*,\\s*')) AS u FROM registry WHERE alt_url IS NOT NULL)""")
def st02_url_lists(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "registry").filter("alt_url is not null").select("id", F.explode(url.registry_forms(F.col("alt_url"))).alias("norm"))


@query(f"""SELECT id, {bare_sql(f"regexp_replace(regexp_replace({bare_sql('url')}, '/$', ''), '[.]$', '')")} AS norm FROM rd_urls""")
def st03_extraction_form(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "rd_urls").select("id", url.extraction_form(F.col("url")).alias("norm"))


@query("SELECT id, regexp_replace(regexp_replace(regexp_replace(url, '^http://', ''), '/$', ''), '^www\\.', '') AS host FROM registry")
def st04_host_form(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "registry").select("id", url.host_form(F.col("url")).alias("host"))


@query(f"SELECT id, nullif(regexp_extract(context, '{url.URL_PATTERN}', 1), '') AS found FROM rd_urls WHERE context IS NOT NULL")
def st05_first_url(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "rd_urls").filter("context is not null").select("id", url.first_url(F.col("context")).alias("found"))


@query(f"SELECT id, unnest(regexp_extract_all(context, '{url.MENTION_PATTERN}', 1)) AS mention FROM rd_urls WHERE context IS NOT NULL")
def st06_mentions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "rd_urls").filter("context is not null").select("id", F.explode(url.mentions(F.col("context"))).alias("mention"))


@query(f"""SELECT id, {host_sql('url')} AS host, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path,
  nullif(regexp_extract(url, '^[^?#]*\\?([^#]*)', 1), '') AS query FROM rd_urls""")
def st07_url_parts(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("url")
    return table(spark, d, "rd_urls").select("id", url.host(u).alias("host"), url.path(u).alias("path"), url.query(u).alias("query"))


@query("SELECT id, length(url) - length(replace(url, '.', '')) AS dots FROM rd_urls")
def st08_count_char(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "rd_urls").select("id", text.count_char(F.col("url"), ".").alias("dots"))


@query("""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, '[ ' || chr(160) || chr(9) || ']{2,}', ' ', 'g'),
  '(?: ' || chr(160) || chr(10) || ')+', chr(10), 'g'), chr(10) || '{2,}', chr(10), 'g') AS t FROM documents""")
def st09_collapse_lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.collapse_lines(F.col("text")).alias("t"))


@query("SELECT doc_id, regexp_replace(text, '[\\p{Z}\\s\\x00-\\x1F\\x7F-\\x{9F}]+', ' ', 'g') AS t FROM documents")
def st10_collapse_space(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.collapse_space(F.col("text")).alias("t"))


@query("SELECT doc_id, regexp_replace(text, '<[^>]+>', '', 'g') AS t FROM documents")
def st11_strip_tags(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.strip_tags(F.col("text")).alias("t"))


@query("SELECT doc_id, regexp_replace(text, '[\\x{10000}-\\x{10FFFF}]', '', 'g') AS t FROM documents")
def st12_drop_supplementary(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.drop_supplementary(F.col("text")).alias("t"))


@query("SELECT id, regexp_replace(resource_name, '[^A-Za-z0-9._-]', '_', 'g') AS file FROM registry")
def st13_file_name(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "registry").select("id", text.file_name(F.col("resource_name")).alias("file"))


@query("SELECT id, md5(url) AS key FROM rd_urls")
def st14_cache_key(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "rd_urls").select("id", F.md5("url").alias("key"))


@query("""SELECT id, coalesce(trim(title), '') = '' AS no_title, coalesce(trim(description), '') = '' AS no_description,
  lower(coalesce(trim(title), '')) = lower(coalesce(trim(description), '')) AS same FROM rd_resource_candidate""")
def st15_blank(spark: SparkSession, d: str) -> DataFrame:
    low = lambda c: F.lower(F.coalesce(F.trim(c), F.lit("")))
    t = table(spark, d, "rd_resource_candidate")
    return t.select("id", text.blank(F.col("title")).alias("no_title"), text.blank(F.col("description")).alias("no_description"), (low("title") == low("description")).alias("same"))


@query("SELECT id, levenshtein(resource_name, abbrev) AS distance FROM registry WHERE resource_name IS NOT NULL AND abbrev IS NOT NULL")
def st16_edit_distance(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "registry").filter("resource_name is not null and abbrev is not null")
    return t.select("id", F.levenshtein("resource_name", "abbrev").alias("distance"))


@query("""SELECT r.id AS ref_id, p.id AS paper_id, (lower(p.title) = lower(r.title) OR starts_with(lower(p.title), lower(r.title)) OR starts_with(lower(r.title), lower(p.title))
  OR coalesce(levenshtein(lower(p.title), lower(r.title)) / CAST(nullif(length(p.title), 0) AS DOUBLE) <= 0.1, false)) AS similar
  FROM rd_paper_reference r JOIN rd_paper p USING (pubmed_id) WHERE r.title IS NOT NULL AND p.title IS NOT NULL""")
def st19_similar_titles(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "rd_paper_reference").filter("title is not null").select(F.col("id").alias("ref_id"), "pubmed_id", F.col("title").alias("other"))
    p = table(spark, d, "rd_paper").filter("title is not null").select(F.col("id").alias("paper_id"), "pubmed_id", "title")
    return r.join(p, "pubmed_id").select("ref_id", "paper_id", text.similar_titles(F.col("title"), F.col("other")).alias("similar"))


@query(f"""WITH t AS (SELECT id, list_concat([{bare_sql('resource_name')}, regexp_replace(regexp_replace({bare_sql('url')}, '^https?://', ''), '/$', ''),
    {bare_sql("CASE WHEN instr(resource_name, ':') > 0 THEN split_part(resource_name, ':', 1) WHEN instr(resource_name, '-') > 0 THEN split_part(resource_name, '-', 1) END")}],
    list_transform(string_split(coalesce(synonym, ''), ','), lambda s: {bare_sql("split_part(s, ':', 1)")})) AS a FROM registry)
SELECT DISTINCT id, term FROM (SELECT id, unnest(a) AS term FROM t) WHERE term IS NOT NULL AND term <> ''""")
def st22_search_terms(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "registry")
    return t.select("id", F.explode(text.search_terms(F.col("resource_name"), F.col("url"), F.col("synonym"))).alias("term"))


@query("""SELECT c.id, (p > 0) AND (p = 1 OR regexp_matches(substr(t, p - 1, 1), '\\s')) AND (substr(t, p + length(n), 1) = '' OR regexp_matches(substr(t, p + length(n), 1), '[\\s0-9]')) AS at_word
FROM (SELECT c.id, c.title AS t, r.resource_name AS n, instr(c.title, r.resource_name) AS p FROM rd_resource_candidate c JOIN rd_urls u ON c.url_id = u.id
  JOIN registry r ON u.registry_id = r.id WHERE c.title IS NOT NULL AND r.resource_name IS NOT NULL) c""")
def st23_at_word(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "rd_resource_candidate").filter("title is not null").select("id", "url_id", "title")
    u = table(spark, d, "rd_urls").filter("registry_id is not null").select(F.col("id").alias("url_id"), "registry_id")
    r = table(spark, d, "registry").filter("resource_name is not null").select(F.col("id").alias("registry_id"), "resource_name")
    return c.join(u, "url_id").join(r, "registry_id").select("id", text.at_word(F.col("resource_name"), F.col("title")).alias("at_word"))


@query("""SELECT id, regexp_replace(trim(regexp_replace(title, '^(in|of|for|to|and|from) ', '')), ' [^\\p{L}]$', '') AS cleaned,
  length(title) <= length(abbrev) OR (length(abbrev) = 1 AND regexp_matches(abbrev, '[0-9\\p{Ll}]')) AS bad FROM (
  SELECT id, abbrev, lower(resource_name) AS title FROM registry WHERE abbrev IS NOT NULL AND resource_name IS NOT NULL)""")
def st24_expansions(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "registry").filter("abbrev is not null and resource_name is not null").select("id", "abbrev", F.lower("resource_name").alias("x"))
    return t.select("id", text.clean_expansion(F.col("x")).alias("cleaned"), text.bad_acronym(F.col("abbrev"), F.col("x")).alias("bad"))


@query("SELECT id, concat_ws(':', pubmed_id, CAST(registry_id AS VARCHAR)) AS key FROM rd_paper_reference")
def st25_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "rd_paper_reference").select("id", F.concat_ws(":", "pubmed_id", F.col("registry_id").cast("string")).alias("key"))


@query("""SELECT id, array_to_string(list_filter(list_transform(string_split(authors, ';'), lambda x: trim(x, ' ')), lambda x: x <> ''), ';') AS joined
  FROM rd_paper_reference WHERE authors IS NOT NULL""")
def st26_join_list(spark: SparkSession, d: str) -> DataFrame:
    names = F.filter(F.transform(F.split("authors", ";"), lambda x: F.trim(x)), lambda x: x != "")
    return table(spark, d, "rd_paper_reference").filter("authors is not null").select("id", F.array_join(names, ";").alias("joined"))


@query("""SELECT id, nullif(regexp_extract(t, 'Old\\s+URL:\\s+(\\S+)', 1), '') AS old_url, nullif(regexp_extract(t, 'Alt\\.?\\s+URL:\\s+(\\S+)', 1), '') AS alt_url FROM (
  SELECT id, 'Old URL: ' || coalesce(old_url, '-') || ' Alt. URL: ' || coalesce(alt_url, '-') AS t FROM registry)""")
def st27_old_alt_urls(spark: SparkSession, d: str) -> DataFrame:
    line = F.concat(F.lit("Old URL: "), F.coalesce("old_url", F.lit("-")), F.lit(" Alt. URL: "), F.coalesce("alt_url", F.lit("-")))
    get = lambda p: F.nullif(F.regexp_extract("t", p, 1), F.lit(""))
    return table(spark, d, "registry").select("id", line.alias("t")).select("id", get(r"Old\s+URL:\s+(\S+)").alias("old_url"), get(r"Alt\.?\s+URL:\s+(\S+)").alias("alt_url"))


@query("SELECT id, regexp_matches(url, '(?i)suppl?') AS supplement FROM rd_urls")
def st28_supplement(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "rd_urls").select("id", F.col("url").rlike(url.SUPPLEMENT_PATTERN).alias("supplement"))


@query("SELECT id, strftime(mod_time, '%m%d%Y') AS batch FROM rd_resource_candidate")
def dt01_day_batch(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "rd_resource_candidate").select("id", dates.day_batch(F.col("mod_time")).alias("batch"))


@query("SELECT id, CAST(date_trunc('month', exec_time) AS TIMESTAMP) AS start FROM rd_publisher_query_log")
def dt02_month_start(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "rd_publisher_query_log").select("id", dates.month_start(F.col("exec_time")).alias("start"))


@query("SELECT batch_id, CAST(strptime(batch_id || '01', '%Y%m%d') AS DATE) AS month, count(*) AS n FROM rd_urls GROUP BY 1, 2")
def dt03_batch_month(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "rd_urls").groupBy("batch_id", dates.batch_month(F.col("batch_id")).alias("month")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT id, regexp_extract(file_path, '([12]\\d\\d\\d)_([A-Z][a-z][a-z])_(\\d{1,2})[\\(_]', 1) || '-' ||
  lpad(CAST(list_position(['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec'], regexp_extract(file_path, '([12]\\d\\d\\d)_([A-Z][a-z][a-z])_(\\d{1,2})[\\(_]', 2)) AS VARCHAR), 2, '0') || '-' ||
  lpad(regexp_extract(file_path, '([12]\\d\\d\\d)_([A-Z][a-z][a-z])_(\\d{1,2})[\\(_]', 3), 2, '0') AS day
  FROM rd_paper WHERE regexp_matches(file_path, '([12]\\d\\d\\d)_(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)_(\\d{1,2})[\\(_]')""")
def dt04_file_date(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "rd_paper").select("id", dates.file_date(F.col("file_path")).alias("day")).filter("day is not null")


@query("SELECT id, concat_ws('-', CAST(year(mod_time) AS VARCHAR), lpad(CAST(month(mod_time) AS VARCHAR), 2, '0'), lpad(CAST(day(mod_time) AS VARCHAR), 2, '0')) AS day FROM rd_resource_candidate")
def dt05_date_text(spark: SparkSession, d: str) -> DataFrame:
    parts = [f(F.col("mod_time")).cast("string") for f in (F.year, F.month, F.day)]
    return table(spark, d, "rd_resource_candidate").select("id", dates.date_text(*parts).alias("day"))


@query("""SELECT id, max(CAST(regexp_extract(s, '(20\\d\\d)', 1) AS INTEGER)) AS year FROM (
    SELECT id, unnest(string_split('Last update ' || substr(t, 1, 10) || '. Updates since 2031. Made in ' || substr(t, 1, 4), '.')) AS s FROM (SELECT id, CAST(mod_time AS VARCHAR) AS t FROM rd_resource_candidate))
  WHERE contains(lower(s), 'update') AND contains(s, '20') AND CAST(regexp_extract(s, '(20\\d\\d)', 1) AS INTEGER) <= 2026 GROUP BY id""")
def dt06_update_year(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("mod_time").cast("string")
    line = F.concat(F.lit("Last update "), F.substring(t, 1, 10), F.lit(". Updates since 2031. Made in "), F.substring(t, 1, 4))
    return table(spark, d, "rd_resource_candidate").select("id", dates.update_year(line, 2026).alias("year")).filter("year is not null")


@query("""SELECT id, CAST(substr(batch_id, 1, 4) AS INTEGER) + 1 AS year FROM rd_resource_candidate WHERE CAST(substr(batch_id, 1, 4) AS INTEGER) + 1 <= 2015""")
def dt07_repaired_year(spark: SparkSession, d: str) -> DataFrame:
    year = F.substring("batch_id", 1, 4)
    line = F.concat(F.lit("Copyright "), year, F.lit(" - "), (year.cast("int") + 1).cast("string"))
    return table(spark, d, "rd_resource_candidate").select("id", dates.repaired_year(line, 2015).alias("year")).filter("year is not null")


QUERIES = Q

"""Page monitoring, name association, full orderings, growing vocabularies, and the line files of the jobs as round trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.functions import dates, text, url
from quillmark.operators import lookup, search, similarity, skew
from quillmark.plans.mining import _VERSIONS, _WORDS, _versions
from quillmark.plans.relational import _urls
from quillmark.plans.scalar import host_sql
from quillmark.runtime import stage_path, table
from quillmark.sources import lines

Q, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def placed(df: DataFrame, order) -> DataFrame:
    """df with the place (from 1) of each row in a total order: ranges are sorted apart, none in one task."""
    x = df.select("*", F.lit("").alias("_all"), order.alias("_order"))
    return skew.numbered(x, "_all", "_order", "place").drop("_all", "_order")


@query("SELECT id, row_number() OVER (ORDER BY registry_id NULLS FIRST, pubmed_id NULLS FIRST, id) AS place FROM rd_paper_reference")
def so01_sorted(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "rd_paper_reference").select("id", "registry_id", "pubmed_id")
    return placed(r, F.struct("registry_id", "pubmed_id", "id")).select("id", F.col("place").cast("long").alias("place"))


@query("""SELECT publication_name, n, row_number() OVER (ORDER BY n DESC, publication_name NULLS FIRST) AS place FROM (SELECT publication_name, count(*) AS n FROM rd_paper_reference GROUP BY 1)""")
def so03_frequent_first(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "rd_paper_reference").groupBy("publication_name").agg(F.count(F.lit(1)).alias("n"))
    return placed(n, F.struct(-F.col("n"), "publication_name")).withColumn("place", F.col("place").cast("long"))


@query("""SELECT initial, abbrev, n, row_number() OVER (ORDER BY initial, n DESC, abbrev) AS place FROM (SELECT lower(substr(abbrev, 1, 1)) AS initial, abbrev, count(*) AS n FROM registry WHERE abbrev <> '' GROUP BY 1, 2)""")
def so04_by_initial(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "registry").filter("abbrev <> ''").groupBy(F.lower(F.substring("abbrev", 1, 1)).alias("initial"), "abbrev").agg(F.count(F.lit(1)).alias("n"))
    return placed(n, F.struct("initial", -F.col("n"), "abbrev")).withColumn("place", F.col("place").cast("long"))


@query("""WITH m AS (SELECT doi, min(pubmed_id) AS pmid FROM rd_paper WHERE doi IS NOT NULL AND pubmed_id IS NOT NULL GROUP BY 1)
SELECT p.id, coalesce(p.pubmed_id, m.pmid) AS pmid FROM rd_paper p LEFT JOIN m ON m.doi = p.doi""")
def sr05_keyed_lookup(spark: SparkSession, d: str) -> DataFrame:
    """The PubMed id of every paper, by its DOI where the paper has none of its own."""
    p = table(spark, d, "rd_paper").select("id", "doi", "pubmed_id")
    m = p.filter("doi is not null and pubmed_id is not null").groupBy("doi").agg(F.min("pubmed_id").alias("pmid"))
    return p.join(m, "doi", "left").select("id", F.coalesce("pubmed_id", "pmid").alias("pmid"))


_W = "regexp_extract_all(lower({}), '([\\p{{L}}\\p{{N}}]+)', 1)"


@query(f"""WITH n AS (SELECT w AS nw, w[1] AS w, len(w) AS k FROM (SELECT DISTINCT {_W.format('resource_type')} AS w FROM registry WHERE resource_type IS NOT NULL) WHERE len(w) > 0),
d AS (SELECT id, dw, unnest(range(len(dw))) AS pos FROM (SELECT id, {_W.format('description')} AS dw FROM rd_urls WHERE description IS NOT NULL)),
s AS (SELECT id, count(*) AS n FROM d JOIN n ON d.dw[pos + 1] = n.w WHERE d.dw[pos + 1 : pos + k] = nw GROUP BY 1)
SELECT u.id, CASE WHEN url IS NULL OR NOT regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.-]*:.+') THEN -1 ELSE coalesce(s.n, 0) END AS score FROM rd_urls u LEFT JOIN s USING (id)""")
def pi05_score(spark: SparkSession, d: str) -> DataFrame:
    """Annotated spans of each mention's page description, by the dictionary annotator over the registry's types; an address that is none scores -1."""
    words = table(spark, d, "registry").filter("resource_type is not null").select(search.word_list(F.col("resource_type")).alias("w")).distinct()
    names = words.select(F.array_join("w", " ").alias("name"), F.array_join("w", " ").alias("key"))
    spans = search.annotate(_urls(spark, d, "id", "description").filter("description is not null"), "id", "description", names).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    bad = F.col("url").isNull() | ~F.col("url").rlike(url.VALID_PATTERN)
    return _urls(spark, d, "id", "url").join(spans, "id", "left").select("id", F.when(bad, -1).otherwise(F.coalesce("n", F.lit(0))).alias("score"))


_NAMED = f"regexp_extract(trim({host_sql('url')}, ' '), '^(?:www\\.)?([^.]+)', 1)"


@query(f"""WITH m AS (SELECT DISTINCT doc_id, {_NAMED} AS entity FROM rd_urls WHERE doc_id IS NOT NULL AND url IS NOT NULL),
a AS (SELECT DISTINCT entity FROM m WHERE length(entity) > 3 AND NOT regexp_matches(entity, '^[0-9.]*$') AND entity NOT IN ({', '.join(f"'{w}'" for w in text.NOISE_ENTITIES)})), r AS (SELECT id, resource_name AS name FROM registry WHERE resource_name <> ''),
x AS (SELECT name AS entity, max(id) AS key FROM r GROUP BY 1), l AS (SELECT lower(name) AS le, max(id) AS key FROM r GROUP BY 1),
h AS (SELECT DISTINCT entity, key FROM (SELECT entity, lower(entity) AS le, lower(name) AS ln, id AS key, instr(lower(name), lower(entity)) AS p FROM a JOIN r ON contains(lower(name), lower(entity)))
  WHERE (p = 1 OR regexp_matches(substr(ln, p - 1, 1), '\\s')) AND (substr(ln, p + length(le), 1) = '' OR regexp_matches(substr(ln, p + length(le), 1), '[\\s0-9]'))),
c AS (SELECT entity, min(key) AS key FROM h GROUP BY entity HAVING count(*) = 1),
e AS (SELECT a.entity, coalesce(x.key, l.key, c.key) AS registry_id FROM a LEFT JOIN x USING (entity) LEFT JOIN l ON l.le = lower(a.entity) LEFT JOIN c ON c.entity = a.entity)
SELECT m.doc_id, m.entity, e.registry_id, EXISTS (SELECT 1 FROM rd_urls u WHERE u.doc_id = m.doc_id AND u.registry_id = e.registry_id) AS duplicate FROM m JOIN e USING (entity) WHERE e.registry_id IS NOT NULL""")
def pi06_entities(spark: SparkSession, d: str) -> DataFrame:
    """Names that mentions carry in their host, with the registry row: that of the name, else ignoring case, else the only one whose name contains it; pairs known from mentions are marked."""
    r = table(spark, d, "registry").select("id", "resource_name").filter("resource_name <> ''")
    name = F.regexp_extract(F.trim(url.host(F.col("url"))), r"^(?:www\.)?([^.]+)", 1)
    mentions = _urls(spark, d, "doc_id", "url").filter("doc_id is not null and url is not null").select("doc_id", name.alias("entity")).distinct()
    entities = mentions.filter(~text.is_noise(F.col("entity"))).select("entity").distinct()
    e = lookup.named(entities, "entity", r, "resource_name", "id").select("entity", F.col("key").alias("registry_id"))
    known = _urls(spark, d, "doc_id", "registry_id").filter("doc_id is not null and registry_id is not null").distinct().withColumn("_k", F.lit(True))
    return mentions.join(e, "entity").join(known, ["doc_id", "registry_id"], "left").select("doc_id", "entity", "registry_id", F.coalesce("_k", F.lit(False)).alias("duplicate"))


#: Drift from which a page counts as updated, besides a newer stated year.
_UPDATED = 0.5


@query(f"""WITH {_VERSIONS}, s AS (SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: w[i] || '|' || w[i+1] || '|' || w[i+2] || '|' || w[i+3] || '|' || w[i+4] || '|')) ELSE [] END AS s
  FROM (SELECT doc_id, {_WORDS} AS w FROM documents WHERE text IS NOT NULL)), p AS (SELECT registry_id, first_id, last_id, a.s AS a, b.s AS b, len(list_intersect(a.s, b.s)) AS shared FROM v JOIN s a ON a.doc_id = first_id JOIN s b ON b.doc_id = last_id),
y AS (SELECT doc_id, max(CAST(regexp_extract(t, '(20\\d\\d)', 1) AS INTEGER)) AS year FROM (SELECT doc_id, unnest(string_split(text, '.')) AS t FROM documents WHERE text IS NOT NULL)
  WHERE contains(lower(t), 'update') AND regexp_matches(t, '20\\d\\d') AND CAST(regexp_extract(t, '(20\\d\\d)', 1) AS INTEGER) <= 2026 GROUP BY 1),
m AS (SELECT *, round(1 - greatest(CASE WHEN len(a) = 0 OR len(b) = 0 THEN 0 ELSE shared / CAST(len(a) + len(b) - shared AS DOUBLE) END, CASE WHEN len(a) = 0 OR len(b) = 0 THEN 0 ELSE shared / CAST(least(len(a), len(b)) AS DOUBLE) END), 6) AS metric FROM p)
SELECT m.registry_id, metric, o.text <> n.text AS changed, y.year, (o.text <> n.text AND metric >= {_UPDATED}) OR coalesce(y.year > z.year, y.year IS NOT NULL AND z.year IS NULL) AS updated
FROM m JOIN documents o ON o.doc_id = first_id JOIN documents n ON n.doc_id = last_id LEFT JOIN y ON y.doc_id = last_id LEFT JOIN y z ON z.doc_id = first_id""")
def pi13_update_check(spark: SparkSession, d: str) -> DataFrame:
    """Oldest against newest page of each resource: drift by shingles, change of the text, the year its newest page states, and whether that makes an update."""
    v = _versions(spark, d)
    drift = similarity.drift(v).select("registry_id", F.round(1 - F.greatest(F.round("similarity", 12), F.round("containment", 12)), 6).alias("metric"))
    docs = table(spark, d, "documents").filter("text is not null")
    page = lambda c, k: docs.select(F.col("doc_id").alias(c), F.md5("text").alias(f"md5_{k}"), dates.update_year(F.col("text"), 2026).alias(f"year_{k}"))
    x = v.select("registry_id", "first_id", "last_id").join(page("first_id", "old"), "first_id").join(page("last_id", "new"), "last_id").join(drift, "registry_id")
    changed = F.col("md5_old") != F.col("md5_new")
    newer = F.coalesce(F.col("year_new") > F.col("year_old"), F.col("year_new").isNotNull() & F.col("year_old").isNull())
    return x.select("registry_id", "metric", changed.alias("changed"), F.col("year_new").alias("year"), ((changed & (F.col("metric") >= _UPDATED)) | newer).alias("updated"))


_RAW = "list_filter(regexp_extract_all(lower(text), '(\\p{L}+)', 1), lambda w: length(w) > 1)"


@query(f"""WITH w AS (SELECT doc_id, {_RAW} AS w FROM documents WHERE text IS NOT NULL), g AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, w FROM w),
t AS (SELECT doc_id, 2 * p AS pos, w[p] AS term FROM g UNION ALL SELECT doc_id, 2 * p + 1, w[p] || ' ' || w[p + 1] FROM g WHERE p < len(w)),
f AS (SELECT term, min((doc_id, pos)) AS f FROM t GROUP BY 1), v AS (SELECT term, row_number() OVER (ORDER BY f) AS term_id FROM f)
SELECT doc_id, term_id, count(*) AS tf FROM t JOIN v USING (term) GROUP BY 1, 2""")
def tx19_growing_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Vectors over a vocabulary of words and pairs of words that grows with the documents: a term's number is its place by first appearance."""
    words = F.filter(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1)), lambda w: F.length(w) > 1)
    w = table(spark, d, "documents").filter("text is not null").select("doc_id", words.alias("w")).filter("size(w) > 0")
    one = F.transform("w", lambda x, i: F.struct((2 * i).alias("pos"), x.alias("term")))
    two = F.transform(F.slice("w", F.lit(2), F.size("w") - 1), lambda x, i: F.struct((2 * i + 1).alias("pos"), F.concat_ws(" ", F.get("w", i), x).alias("term")))
    t = w.select("doc_id", F.explode(F.when(F.size("w") > 1, F.concat(one, two)).otherwise(one)).alias("t")).select("doc_id", "t.pos", "t.term")
    counts = t.groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf"), F.min("pos").alias("pos"))
    first = counts.groupBy("term").agg(F.min(F.struct("doc_id", "pos")).alias("first"))
    vocabulary = placed(first, F.col("first")).select("term", F.col("place").cast("long").alias("term_id"))
    return counts.join(vocabulary, "term").select("doc_id", "term_id", "tf")


@query("""SELECT doc_id, len(list_filter(w, lambda x: length(x) > 1)) AS tokens, CAST(list_aggregate(list_transform(list_filter(list_transform(w, lambda x: CASE WHEN regexp_matches(x, '[^.]\\.$') THEN substr(x, 1, length(x) - 1) ELSE x END), lambda x: length(x) > 1), lambda x: length(x)), 'sum') AS INTEGER) AS letters
FROM (SELECT doc_id, regexp_extract_all(text, '([\\p{L}\\p{N}][^\\s,;:!?()]*)', 1) AS w FROM documents WHERE text IS NOT NULL)""")
def tx13_split_tokens(spark: SparkSession, d: str) -> DataFrame:
    """Tokens of a classifier: those of one character go, a single full stop at the end is split off."""
    w = F.regexp_extract_all("text", F.lit(r"([\p{L}\p{N}][^\s,;:!?()]*)"), F.lit(1))
    long = lambda x: F.length(x) > 1
    docs = table(spark, d, "documents").filter("text is not null").select("doc_id", w.alias("w"))
    bare = F.filter(text.split_period(F.col("w")), long)
    total = F.aggregate(bare, F.lit(0), lambda a, x: a + F.length(x))
    return docs.select("doc_id", F.size(F.filter("w", long)).alias("tokens"), F.when(F.size(bare) > 0, total).alias("letters"))


# Files: what a job writes is read again by its source.


def _written(spark: SparkSession, df: DataFrame, name: str) -> str:
    path = stage_path(spark, name)
    df.write.text(path)
    return path


@query("""SELECT doc_id, CAST(count(*) AS VARCHAR) || ' ' || string_agg(term_id || ':' || tf, ' ' ORDER BY term_id) AS line FROM (
  SELECT doc_id, length(w) AS term_id, count(*) AS tf FROM (SELECT doc_id, unnest(regexp_extract_all(text, '(\\p{L}+)', 1)) AS w FROM documents WHERE text IS NOT NULL) GROUP BY 1, 2) GROUP BY 1""")
def sk10_sparse_lines(spark: SparkSession, d: str) -> DataFrame:
    """Sparse vectors as lines `n id:count ...`; the ids here are the lengths of words."""
    w = table(spark, d, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"(\p{L}+)"), F.lit(1))).alias("w"))
    return lines.sparse_lines(w.groupBy("doc_id", F.length("w").alias("term_id")).agg(F.count(F.lit(1)).alias("tf")), "doc_id", "term_id", "tf")


@query(f"""SELECT host, n, row_number() OVER (ORDER BY n DESC, host) AS place FROM (SELECT {host_sql('url')} AS host, count(*) AS n FROM rd_urls GROUP BY 1) WHERE host IS NOT NULL""")
def sk12_frequency_csv(spark: SparkSession, d: str) -> DataFrame:
    """Mentions of each host, the most frequent first, through the CSV of the report."""
    n = _urls(spark, d, url.host(F.col("url")).alias("host")).filter("host is not null").groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    path = stage_path(spark, "frequencies")
    lines.write_csv(placed(n, F.struct(-F.col("n"), "host")).select("place", "host", "n"), path)
    return lines.read_csv(spark, path, "place long, host string, n long")


@query("SELECT id, url || ' X ' || trim(regexp_replace(description, '\\s+', ' ', 'g'), ' ') AS line FROM registry WHERE url IS NOT NULL AND trim(regexp_replace(description, '\\s+', ' ', 'g'), ' ') <> ''")
def sk13_topic_lines(spark: SparkSession, d: str) -> DataFrame:
    """Training lines of the topic models: address, label X, text."""
    r = table(spark, d, "registry").select("id", "url", F.trim(F.regexp_replace("description", r"\s+", " ")).alias("content"))
    return r.filter("url is not null and content <> ''").select("id", lines.topic_line(F.col("url"), F.col("content")).alias("line"))


_SAFE = "replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


@query(f"""SELECT id, '<sentence>' || replace(x, n, '<entity>' || n || '</entity>') || '</sentence>' AS sentence FROM (SELECT id, {_SAFE.format('context')} AS x, {_SAFE.format('url')} AS n FROM rd_urls) WHERE n <> '' AND contains(x, n)""")
def sk15_entity_corpus(spark: SparkSession, d: str) -> DataFrame:
    """Training sentences of the entity recogniser: paragraphs with the address they mention as an entity."""
    u = _urls(spark, d, "id", "url", "context").filter("url <> ''")
    return u.select("id", lines.marked_entity(F.col("context"), F.col("url")).alias("sentence")).filter("sentence is not null")


@query("SELECT id, resource_name AS freetext FROM registry WHERE resource_name IS NOT NULL")
def sr24_registry_dump(spark: SparkSession, d: str) -> DataFrame:
    """The registry through its XML dump of article elements."""
    path = stage_path(spark, "dump")
    table(spark, d, "registry").filter("resource_name is not null").select("id", F.col("resource_name").alias("freetext")).write.format("xml").option("rootTag", "articles").option("rowTag", "article").save(path)
    return lines.registry_dump(spark, path)


@query(f"SELECT DISTINCT lower(trim({host_sql('url')}, ' ')) AS host, lower(resource_type) AS type FROM registry WHERE {host_sql('url')} IS NOT NULL AND resource_type IS NOT NULL")
def sr19_host_types(spark: SparkSession, d: str) -> DataFrame:
    path = stage_path(spark, "hosts")
    r = table(spark, d, "registry").select(url.host(F.col("url")).alias("host"), "id", "resource_type").filter("host is not null and resource_type is not null")
    lines.write_csv(r, path)
    return lines.host_types(spark, path).distinct()


@query("SELECT CAST(id AS INTEGER) AS id, abbrev AS value FROM registry WHERE abbrev <> '' AND NOT regexp_matches(abbrev, '^\\s|\\s$')")
def sr21_lookup_file(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "registry").filter("abbrev <> ''").filter(~F.col("abbrev").rlike(r"^\s|\s$"))
    path = _written(spark, r.select(F.concat_ws(":", "id", "abbrev").alias("value")), "lookup")
    return lines.lookup_table(spark.read.text(path).withColumnRenamed("value", "line"))


@query("SELECT 'r' || id AS name, CASE WHEN url IS NULL THEN 'bad' ELSE 'good' END AS label, nif_id AS data FROM registry WHERE nif_id <> ''")
def sr23_instances(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "registry").filter("nif_id <> ''")
    path = _written(spark, r.select(F.concat_ws(" ", F.concat(F.lit("r"), "id"), F.when(F.col("url").isNull(), "bad").otherwise("good"), "nif_id").alias("value")), "instances")
    return lines.instances(spark.read.text(path).withColumnRenamed("value", "line"))


@query("SELECT nif_id, min(id) AS id FROM registry WHERE regexp_matches(nif_id, '^[A-Za-z0-9_-]+$') GROUP BY 1")
def sr26_first_ids(spark: SparkSession, d: str) -> DataFrame:
    log = F.concat(F.lit("INFO saved nifId:"), "nif_id", F.lit(" of a batch :: "), "id")
    r = table(spark, d, "registry").filter(F.col("nif_id").rlike("^[A-Za-z0-9_-]+$")).select(F.col("id").alias("n"), log.alias("line"))
    return lines.first_ids(r)


@query("SELECT url, old_url AS redirect_url, resource_name AS title FROM registry WHERE url IS NOT NULL AND resource_name IS NOT NULL AND NOT regexp_matches(url, '^\\s|\\s$') AND NOT regexp_matches(resource_name, '^\\s|\\s$') AND resource_name <> '' AND (old_url IS NULL OR old_url <> '' AND NOT regexp_matches(old_url, '^\\s|\\s$'))")
def sr29_cached_pages(spark: SparkSession, d: str) -> DataFrame:
    path, odd = stage_path(spark, "pages"), r"^\s|\s$"
    r = table(spark, d, "registry").filter("url is not null and resource_name <> '' and (old_url is null or old_url <> '')")
    r = r.filter(~F.col("url").rlike(odd) & ~F.col("resource_name").rlike(odd) & (F.col("old_url").isNull() | ~F.col("old_url").rlike(odd)))
    r.select(F.col("url").alias("_url"), F.col("old_url").alias("_redirect-url"), F.col("resource_name").alias("title")).write.format("xml").option("rootTag", "docs").option("rowTag", "doc").save(path)
    return lines.cached_pages(spark, path).select("url", "redirect_url", "title")


QUERIES = Q

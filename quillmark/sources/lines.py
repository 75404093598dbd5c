"""Line-oriented and simple files: labelled XML, host clusters, instance lines, vocabularies, matrices, key-value logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, n, line): numbered lines; the number is the order within a file, which is read as one split."""
    t = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.split("value", "\r?\n")).alias("n", "line"))
    return t


def host_clusters(df: DataFrame) -> DataFrame:
    """(host, registry, similarity, url) from lines: a host line, 'Registry:' lines, and similarity lines after the url they are of."""
    w = Window.partitionBy("file").orderBy("n")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    host = F.when(F.col("line").rlike(r"^[\w-]+(\.[\w-]+)+\s*\(\d+\)$"), F.regexp_extract("line", r"^(\S+)", 1))
    reg = F.when(F.col("line").startswith("Registry:"), F.trim(F.substring_index("line", ":", -1)))
    x = df.withColumn("host", F.last(host, ignorenulls=True).over(run)).withColumn("registry", F.last(reg, ignorenulls=True).over(run)).withColumn("before", F.lag("line").over(w))
    sim = F.regexp_extract("line", r"^\s*(?:sim|similarity)\s*[:=]\s*([0-9.]+)", 1)
    return x.filter(sim != "").select("host", "registry", sim.cast("double").alias("similarity"), F.trim("before").alias("url"))


def instances(df: DataFrame) -> DataFrame:
    """(name, label, data) of lines 'name label data'."""
    g = lambda k: F.regexp_extract("line", r"^(\S*)[\s,]*(\S*)[\s,]*(.*)$", k)
    return df.filter("line <> ''").select(g(1).alias("name"), g(2).alias("label"), g(3).alias("data"))


def lookup_table(df: DataFrame, sep: str = ":") -> DataFrame:
    """(id, value) of lines 'id:value'."""
    return df.filter(F.col("line").contains(sep)).select(F.trim(F.substring_index("line", sep, 1)).try_cast("int").alias("id"), F.trim(F.expr(f"substring(line, instr(line, '{sep}') + 1)")).alias("value"))


def matrix(df: DataFrame) -> DataFrame:
    """(n, row): rows of numbers divided by white space."""
    return df.filter("trim(line) <> ''").select("n", F.transform(F.split(F.trim("line"), r"\s+"), lambda x: x.try_cast("double")).alias("row"))


def first_ids(df: DataFrame) -> DataFrame:
    """(nif_id, id): the first id that a log gives for each key."""
    p = r".+nifId:([\w-]+).+::\s+(\d+)"
    x = df.filter(F.col("line").rlike(p)).select(F.regexp_extract("line", p, 1).alias("nif_id"), F.regexp_extract("line", p, 2).cast("long").alias("id"), "n")
    return x.groupBy("nif_id").agg(F.min_by("id", "n").alias("id"))


def labelled_documents(spark: SparkSession, path: str) -> DataFrame:
    """(nif_id, url, type, label, content) of <data> elements."""
    x = spark.read.format("xml").option("rowTag", "data").option("valueTag", "content").option("attributePrefix", "").load(path)
    cols = {c.lower().replace("-", "_"): c for c in x.columns}
    return x.select(*[(F.col(f"`{cols[c]}`") if c in cols else F.lit(None)).cast("string").alias(c) for c in ("nif_id", "url", "type", "label", "content")])


def cached_pages(spark: SparkSession, path: str) -> DataFrame:
    """(url, redirect_url, title, description, content) of <doc url redirect-url> elements."""
    x = spark.read.schema("`_url` string, `_redirect-url` string, title string, description string, content string").format("xml").option("rowTag", "doc").load(path)
    return x.select(F.col("_url").alias("url"), F.col("`_redirect-url`").alias("redirect_url"), "title", "description", "content")


#: How the CSV files are written and read: every value in quotes, nothing trimmed.
_CSV = {"quoteAll": "true", "escape": '"', "multiLine": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_csv(df: DataFrame, path: str) -> None:
    df.write.options(**_CSV).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).options(**_CSV).csv(path)


def host_types(spark: SparkSession, path: str) -> DataFrame:
    """(host, type) of a CSV with the host in the first and the type in the third column."""
    x = spark.read.options(**_CSV).csv(path)
    return x.select(F.lower(F.trim("_c0")).alias("host"), F.lower(F.trim("_c2")).alias("type"))


def registry_dump(spark: SparkSession, path: str) -> DataFrame:
    """(id, freetext) of the <article> elements of a registry dump."""
    return spark.read.schema("id long, freetext string").format("xml").option("rowTag", "article").load(path)


def sparse_lines(counts: DataFrame, doc: str, term: str, n: str) -> DataFrame:
    """(doc, line): `n id:count ...` of each document, ids ascending."""
    pairs = counts.groupBy(doc).agg(F.array_sort(F.collect_list(F.struct(term, n))).alias("p"))
    return pairs.select(doc, F.concat_ws(" ", F.size("p").cast("string"), F.array_join(F.transform("p", lambda x: F.concat_ws(":", x[term], x[n])), " ")).alias("line"))


def topic_line(key: Column, content: Column) -> Column:
    """`key X content`, the training line of the topic models."""
    return F.concat_ws(" ", key, F.lit("X"), content)


def marked_entity(sentence: Column, name: Column) -> Column:
    """The sentence as XML with every occurrence of the name as an entity; null where it doesn't occur."""
    safe = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    s, n = safe(sentence), safe(name)
    return F.when(F.contains(s, n), F.concat(F.lit("<sentence>"), F.replace(s, n, F.concat(F.lit("<entity>"), n, F.lit("</entity>"))), F.lit("</sentence>")))


def read_database(spark: SparkSession, address: str, name: str, **options: str) -> DataFrame:
    """A table of a second database, its schema as the database gives it; partitionColumn, lowerBound, upperBound and numPartitions spread the read."""
    return spark.read.format("jdbc").options(url=address, dbtable=name, **options).load()


def write_libsvm(df: DataFrame, path: str) -> None:
    """(label, features) as svm-light lines."""
    df.select("label", "features").write.format("libsvm").save(path)


def overwrite_batches(df: DataFrame, path: str, batch: str = "batch_id") -> None:
    """Writes a table by batch; a batch written again replaces itself alone."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(batch).parquet(path)

"""Lookups of mentions in a dimension: by address variants, by host, by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.functions import text, url


def registry_keys(registry: DataFrame) -> DataFrame:
    """(key, registry_id): one row for each address of the registry in registry form; of several owners the largest id is taken."""
    own = F.array(url.registry_form(F.col("url")), url.registry_form(F.col("old_url")))
    alt = F.when(F.col("alt_url").isNotNull(), url.registry_forms(F.col("alt_url"))).otherwise(F.array().cast("array<string>"))
    keys = registry.select(F.col("id").alias("registry_id"), F.explode(F.concat(own, alt)).alias("key"))
    return keys.filter("key is not null and key <> 'http://'").groupBy("key").agg(F.max("registry_id").alias("registry_id"))


def variant_lookup(rows: DataFrame, id_col: str, address: str, keys: DataFrame) -> DataFrame:
    """(id, variant, registry_id): the last matching variant of each address, as a left join; null where none matches.

    Distinct addresses are looked up, not rows, so a hot address meets the dimension once.
    """
    addresses = rows.filter(F.col(address).isNotNull()).select(F.col(address).alias("_a")).distinct()
    tries = addresses.select("_a", F.explode(url.variants(url.registry_form(F.col("_a")))).alias("v")).select("_a", "v.priority", F.col("v.variant").alias("key"))
    best = tries.join(keys, "key").groupBy("_a").agg(F.max_by(F.struct(F.col("key").alias("variant"), "registry_id"), "priority").alias("b"))
    found = rows.select(rows[id_col].alias("id"), F.col(address).alias("_a")).join(best, "_a", "left")
    return found.select("id", F.col("b.variant").alias("variant"), F.col("b.registry_id").alias("registry_id"))


def host_lookup(rows: DataFrame, id_col: str, address: str, registry: DataFrame) -> DataFrame:
    """(id, host, registry_id) of rows whose host, without www., is that of a registry address (of several the smallest id)."""
    form = lambda c: F.regexp_replace(url.host(c), r"^www\.", "")
    dim = registry.select(form(F.col("url")).alias("host"), F.col("id").alias("registry_id")).filter("host is not null").groupBy("host").agg(F.min("registry_id").alias("registry_id"))
    return rows.select(rows[id_col].alias("id"), form(F.col(address)).alias("host")).join(dim, "host")


def unique_containment(entities: DataFrame, entity: str, names: DataFrame, name: str, key: str) -> DataFrame:
    """(entity, key): the only name that contains the entity as words (a digit may follow), ignoring case.

    No nested loop: an entity is looked up by its first word, and hits are verified on the whole text.
    """
    first = F.substring_index(F.lower(F.col("entity")), " ", 1)
    e = entities.select(F.col(entity).alias("entity")).filter("entity is not null and entity <> ''").distinct()
    e = e.select("entity", F.lower("entity").alias("le"), first.alias("w"))
    n = names.select(F.lower(F.col(name)).alias("ln"), names[key].alias("key")).filter("ln is not null")
    stems = F.transform(F.sequence(F.lit(1), F.length("word")), lambda k: F.when(F.substr("word", k + 1, F.lit(1)).rlike("^[0-9]$") | (k == F.length("word")), F.substr("word", F.lit(1), k)))
    words = n.select("ln", "key", F.explode(F.array_distinct(F.split("ln", r"\s+"))).alias("word"))
    words = words.select("ln", "key", F.explode(F.array_compact(stems)).alias("w")).distinct()
    hits = e.join(words, "w").filter(text.at_word(F.col("le"), F.col("ln"))).select("entity", "key").distinct()
    return hits.groupBy("entity").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("key")).filter("n = 1").drop("n")


def named(entities: DataFrame, entity: str, names: DataFrame, name: str, key: str) -> DataFrame:
    """(entity, key): the row of that name, else of that name ignoring case (of several the largest key), else the only one whose name contains it."""
    e = entities.select(F.col(entity).alias("entity")).filter("entity <> ''").distinct()
    by = lambda form, k: names.filter(names[name].isNotNull()).groupBy(form(names[name]).alias("form")).agg(F.max(names[key]).alias(k))
    x = e.join(by(lambda c: c, "k1").withColumnRenamed("form", "entity"), "entity", "left").withColumn("form", F.lower("entity")).join(by(F.lower, "k2"), "form", "left")
    x = x.join(unique_containment(e, "entity", names, name, key).withColumnRenamed("key", "k3"), "entity", "left")
    return x.select("entity", F.coalesce("k1", "k2", "k3").alias("key")).filter("key is not null")


def curated(rows: DataFrame, hosts: DataFrame, pages: DataFrame) -> DataFrame:
    """rows(id, host, page) with the registry id of the page's own entry, else that of its host: hosts(host, registry_id), pages(page, registry_id)."""
    h = hosts.select("host", F.col("registry_id").alias("_h"))
    p = pages.select("page", F.col("registry_id").alias("_p"))
    return rows.join(h, "host", "left").join(p, "page", "left").select("id", F.coalesce("_p", "_h").alias("registry_id"))


def repoint(rows: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """rows with column replaced by mapping(old_id, new_id) where it has an entry."""
    m = mapping.select(F.col("old_id").alias(column), F.col("new_id").alias("_new"))
    return rows.join(m, column, "left").withColumn(column, F.coalesce("_new", column)).drop("_new")


def upsert(target: DataFrame, changes: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """target with the rows of changes in place of those of equal keys, and the others of changes added."""
    c = changes.select(*keys, *[F.col(x).alias(f"_{x}") for x in columns], F.lit(True).alias("_in"))
    j = target.select(*keys, *columns).join(c, keys, "full_outer")
    return j.select(*keys, *[F.when(F.col("_in"), F.col(f"_{x}")).otherwise(F.col(x)).alias(x) for x in columns])


def sync(source: DataFrame, target: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, action, columns): what makes target like source: insert, update (of rows that differ), keep, or missing in source."""
    s = source.select(key, *[F.col(c).alias(f"_{c}") for c in columns], F.lit(True).alias("_s"))
    t = target.select(key, *columns, F.lit(True).alias("_t"))
    same: Column = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    action = F.when(F.col("_t").isNull(), "insert").when(F.col("_s").isNull(), "missing").when(same, "keep").otherwise("update")
    return s.join(t, key, "full_outer").select(key, action.alias("action"), *[F.coalesce(f"_{c}", c).alias(c) for c in columns])

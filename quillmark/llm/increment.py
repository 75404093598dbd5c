"""Deduplicating new batches against all history, by a segment index for bounded edit distance.

A record repeats an accepted record of an earlier batch if both have one address, or one host and descriptions whose
word sets share at least a given part of their union. A word set is a string over words, in a fixed order (by the words'
hashes, so that frequent words lie scattered): the insertion-deletion distance of two such strings is the size of the
symmetric difference, and a similarity J bounds it by (1 - J) / (1 + J) * (|a| + |b|), at most (1 - J) / J * |b|.

Method: segment index. An accepted string of length l is stored in floor((1 - J) / J * l) + 1 segments, each with its host,
length, number and position; so the index is linear in the text. Within the bound one segment at least stands unchanged in a
similar string. A batch probes the index with substrings of its strings: of the lengths that segments have, and only at
positions that the number of the segment and both lengths allow. Hits are verified by the bounded distance on the whole
strings. Accepted records of the batch are appended as segments; no earlier text is read but those hit. Addresses are the
case of distance 0.

Segments that very many strings share (boilerplate of one host) are refined: their first entries are tried in order of
acceptance, which settles near copies, and for the rest the remaining words of both strings are cut into segments again, as
the same bound holds for them. So no key meets all of its pairs, and none is dropped.

Rows of one batch with one address and word set are one node; copies are never compared with each other. Texts are
identified by 128-bit digests; 64-bit hashes are only looked up, and verified.

Defined cases: a null or empty address matches nothing by address; an empty host or null description matches nothing by
description; two descriptions without words have no union and don't match; repeats within one batch are all accepted;
rows without a batch or id are left out; repeated ids count as one row, that of the first batch; texts of any length are
compared in full; an empty table gives an empty result. Of several accepted partners the one of the earliest batch, then the
smallest id, is taken.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmark.operators.skew import heavy_keys, split_join
from quillmark.runtime import shuffled, stage_path, staged

SHARE = 0.8
#: Index entries of one key that a probe meets at once; keys with more are refined, after their FIRST entries.
FAN, FIRST = 1000, 32
#: Rows of small batches that one step over a history takes together, or a STEPS-th of all rows where that is more: each step reads the store, so
#: their number must not grow with the rows.
STEP_ROWS, STEPS = 20_000, 4
#: Pairs a row, at most, that the segments of a larger step may hold: they aren't refined, so a step with more is taken in parts of STEP_ROWS.
STEP_PAIRS = 200
#: Nodes of a bucket: fewer buckets than shuffle partitions, as each step writes and reads a file of each.
BUCKET_ROWS = 40_000


def host(url: Column) -> Column:
    """Host in lower case, without leading www., without white space and punctuation at its ends and inside."""
    bare = F.lower(F.regexp_replace(url, r"[\s\p{Z}\p{C}]+", ""))
    bare = F.regexp_replace(bare, r"^[^\p{L}\p{N}]*([a-z][a-z0-9+.-]*:/*)?", "")
    h = F.regexp_extract(bare, r"^[^/?#:]*", 0)
    return F.regexp_replace(F.regexp_replace(h, r"^[^\p{L}\p{N}]*(www\.)?|[^\p{L}\p{N}]+$", ""), r"[^\p{L}\p{N}]+$", "")


def word_set(text: Column) -> Column:
    """Sorted distinct runs of letters and digits in lower case; null for null."""
    return F.sort_array(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))))


def _tolerance(size: Column, share: float) -> Column:
    """Most that the symmetric difference of a set of this size and any similar one can be."""
    return F.floor(size * ((1 - share) / share) + 1e-9).cast("int")


def _rest(words: Column, cuts: Column) -> Column:
    """The words without the stretches (at, len) cut out one after the other."""
    return F.aggregate(cuts, words, lambda w, c: F.concat(F.slice(w, F.lit(1), c["at"]), F.slice(w, c["at"] + c["len"] + 1, F.size(w))))


def _index_entries(sets: DataFrame, prefix: str, left: Column, share: float) -> DataFrame:
    """sets with a row for each segment of `left`: key, seg, at, len. With fewer words than segments one entry stands for all (len 0)."""
    parts, n = _tolerance(F.col("size"), share) + 1, F.size("left")
    cut = lambda i: F.floor(i * n / parts).cast("int")
    each = F.transform(F.sequence(F.lit(0), parts - 1), lambda i: F.struct(i.alias("seg"), cut(i).alias("at"), (cut(i + 1) - cut(i)).alias("len")))
    whole = F.array(F.struct(F.lit(-1).alias("seg"), F.lit(0).alias("at"), F.lit(0).alias("len")))
    x = sets.withColumn("left", left).withColumn("e", F.explode(F.when(n >= parts, each).otherwise(whole)))
    key = F.xxhash64(F.col(prefix), F.slice("left", F.col("e.at") + 1, F.col("e.len")))
    return x.withColumn("_k", key).drop("key", "seg", "at", "len").select("*", F.col("_k").alias("key"), "e.seg", "e.at", "e.len").drop("left", "e", "_k")


def _probe_entries(sets: DataFrame, prefix: str, left: Column, share: float) -> DataFrame:
    """sets with a row for each substring of `left` that may be a segment of a similar string: key, at, len."""
    gone = F.col("size") - F.size("left")
    partner = F.sequence(F.ceil(F.col("size") * share - 1e-9).cast("int"), F.floor(F.col("size") / share + 1e-9).cast("int"))

    def lengths(m):
        parts, rest = _tolerance(m, share) + 1, m - gone
        return F.when(rest >= parts, F.array(F.floor(rest / parts).cast("int"), F.ceil(rest / parts).cast("int"))).otherwise(F.array(F.lit(0)))

    kinds = F.array_distinct(F.flatten(F.transform(partner, lengths)))
    x = sets.withColumn("left", left).withColumn("len", F.explode(F.filter(kinds, lambda k: (k >= 0) & (k <= F.size("left")))))
    x = x.withColumn("at", F.explode(F.sequence(F.lit(0), F.when(F.col("len") == 0, 0).otherwise(F.size("left") - F.col("len")))))
    return x.withColumn("key", F.xxhash64(F.col(prefix), F.slice("left", F.col("at") + 1, F.col("len")))).drop("left")


def _allowed(share: float) -> Column:
    """Whether lengths (n of the probe, size) and positions (p of the probe, at) of a hit allow the bounded distance."""
    shift, more, most = F.col("p") - F.col("at"), F.col("n") - F.col("size"), _tolerance(F.col("size"), share)
    near = (F.abs(shift) <= F.col("seg")) & (F.abs(shift - more) <= most - F.col("seg"))
    lengths = F.abs(more) <= F.floor((F.col("n") + F.col("size")) * ((1 - share) / (1 + share)) + 1e-9)
    return lengths & ((F.col("seg") < 0) | near)


def _marks() -> list[Column]:
    """A bit for each word's hash, 128 in all: two sets differ in at least as many words as bits."""
    bit = lambda w: F.pmod(F.xxhash64(w), F.lit(128))
    one = lambda k: lambda acc, w: F.when(F.floor(bit(w) / 64) == k, acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(bit(w), F.lit(64)).cast("int")))).otherwise(acc)
    return [F.aggregate("words", F.lit(0).cast("long"), one(k)).alias(f"m{k}") for k in (0, 1)]


def _verified(hits: DataFrame, new: DataFrame, old: DataFrame, share: float) -> DataFrame:
    """The hits (a, b, ...) whose whole sets are within the bounded distance. The marks of both spare most hits the texts."""
    of = lambda df, x: df.select(F.col("set").alias(x), F.col("size").alias(f"{x}_n"), F.col("m0").alias(f"{x}0"), F.col("m1").alias(f"{x}1"))
    cols = hits.columns
    hits = hits.join(shuffled(of(new, "a")), "a").withColumnRenamed("b", "set").join(shuffled(of(old, "b").withColumnRenamed("b", "set")), "set")
    apart = F.bit_count(F.col("a0").bitwiseXOR(F.col("b0"))) + F.bit_count(F.col("a1").bitwiseXOR(F.col("b1")))
    hits = hits.filter(apart <= (F.col("a_n") + F.col("b_n")) * ((1 - share) / (1 + share)) + 1e-9).select("set", *[c for c in cols if c != "b"])
    hits = hits.join(shuffled(old.select("set", F.col("host").alias("hb"), F.col("words").alias("wb"))), "set").withColumnRenamed("set", "b")
    hits = hits.join(shuffled(new.select(F.col("set").alias("a"), F.col("host").alias("ha"), F.col("words").alias("wa"))), "a")
    common, both = F.size(F.array_intersect("wa", "wb")), F.size("wa") + F.size("wb")
    close = both - 2 * common <= (both - common) * (1 - share) + 1e-9
    return hits.filter((F.col("ha") == F.col("hb")) & close).select(*cols)


def _hits(probe: DataFrame, index: DataFrame, share: float) -> DataFrame:
    p = probe.select("key", F.col("set").alias("a"), F.col("size").alias("n"), F.col("at").alias("p"))
    i = index.select("key", F.col("set").alias("b"), "size", "seg", "at", "batch", "id")
    return p.join(shuffled(i), "key").filter(_allowed(share)).select("key", "a", "b", "batch", "id")


def nearest_sets(new: DataFrame, segments: DataFrame, old: DataFrame, share: float = SHARE, fan: int = FAN) -> DataFrame:
    """(set, p): for each set of new the earliest (batch, id) of the similar sets of old.

    new: sized(sets); old: the same with batch, id; segments: segment_index(old). Stored tables are bucketed by key and by
    set, so that only what belongs to new is shuffled.
    """
    probe = _probe_entries(new.select("set", "host", "words", "size"), "host", F.col("words"), share).select("key", "set", "size", "at", "len").withColumn("cuts", _no_cuts())
    met = segments.withColumn("cuts", _no_cuts())
    found = []
    pair = ["a", "b", "batch", "id"]
    while True:
        hot = staged(met.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > fan).select("key"), "hot")
        many = hot.limit(1).count() > 0
        calm = met.join(hot, "key", "left_anti") if many else met
        best = _verified(_hits(probe, calm, share).select(*pair).distinct(), new, old, share)
        found.append(best.groupBy("a").agg(F.min(F.struct("batch", "id")).alias("p")))
        if not many:
            break
        mine, theirs = staged(probe.join(hot, "key", "left_semi"), "mine"), met.join(hot, "key", "left_semi")
        theirs = staged(theirs.join(shuffled(mine.select("key").distinct()), "key", "left_semi"), "theirs")
        turn = F.row_number().over(Window.partitionBy("key").orderBy("batch", "id"))
        first = theirs.withColumn("turn", turn).filter(F.col("turn") <= FIRST)
        settled = staged(_verified(_hits(mine, first, share), new, old, share).groupBy("key", "a").agg(F.min(F.struct("batch", "id")).alias("p")), "settled")
        found.append(settled.groupBy("a").agg(F.min("p").alias("p")))
        mine = mine.join(shuffled(settled.select("key", F.col("a").alias("set"))), ["key", "set"], "left_anti")
        # Strings without words left are all but verified by what was cut out of them; they meet as they are.
        best = _verified(_hits(mine, theirs.filter("len = 0"), share).select(*pair).distinct(), new, old, share)
        found.append(best.groupBy("a").agg(F.min(F.struct("batch", "id")).alias("p")))
        cut, rest = F.concat("cuts", F.array(F.struct("at", "len"))), _rest(F.col("words"), F.col("cuts"))
        mine = mine.filter("len > 0").select(F.col("key").alias("up"), "set", "size", cut.alias("cuts")).join(shuffled(new.select("set", "words")), "set")
        theirs = theirs.filter("len > 0").select(F.col("key").alias("up"), "set", "size", "batch", "id", cut.alias("cuts")).join(shuffled(old.select("set", "words")), "set")
        cols = ["key", "set", "size", "at", "len", "cuts"]
        probe = staged(_probe_entries(mine, "up", rest, share).select(*cols), "probe")
        deep = _index_entries(theirs, "up", rest, share).select(*cols, "seg", "batch", "id")
        met = staged(deep.join(shuffled(probe.select("key").distinct()), "key", "left_semi"), "met")
    all_found = found[0]
    for f in found[1:]:
        all_found = all_found.unionByName(f)
    return all_found.groupBy(F.col("a").alias("set")).agg(F.min("p").alias("p"))


def _no_cuts() -> Column:
    return F.array().cast("array<struct<at:int,len:int>>")


def sized(sets: DataFrame) -> DataFrame:
    """sets(set, host, words) with their sizes and marks."""
    return sets.select("*", F.size("words").alias("size"), *_marks())


def segment_index(sets: DataFrame, share: float = SHARE) -> DataFrame:
    """(key, set, size, seg, at, len, batch, id): a row for each segment of sets(set, host, words, size, batch, id)."""
    return _index_entries(sets.select("set", "host", "words", "size", "batch", "id"), "host", F.col("words"), share).select("key", "set", "size", "seg", "at", "len", "batch", "id")


class Store:
    """What is kept of accepted records, in a folder: nodes by address, word sets by their digest, segments by their key, appended step by step.

    Each table is bucketed by its key, so that a batch is shuffled to it and not the other way round. The number of buckets is
    part of the store's place: it must be opened with the number that it was made with. Tables of the catalogue only
    name the folder; a new session names them again.
    """

    BUCKETED = {"nodes": "addr", "sets": "set", "segments": "key"}

    def __init__(self, spark: SparkSession, folder: str, id_type: str = "bigint", buckets: int | None = None):
        self.spark, self.folder = spark, folder
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        place = f"batch string, id {id_type}"
        self.schemas = {
            # p is the partner of a node that repeats something, null for an accepted one.
            "nodes": f"node binary, n bigint, addr string, set binary, {place}, p struct<{place.replace(' ', ':').replace(',:', ', ')}>",
            "sets": f"set binary, host string, words array<string>, size int, m0 bigint, m1 bigint, {place}",
            "segments": f"key bigint, set binary, size int, seg int, at int, len int, {place}",
        }
        self.name = "quillmark_" + hashlib.md5(folder.encode()).hexdigest()
        for table, schema in self.schemas.items():
            key = self.BUCKETED[table]
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.name}_{table} ({schema}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {self.buckets} BUCKETS LOCATION '{folder}/{table}'"
            )

    def read(self, table: str) -> DataFrame:
        self.spark.catalog.refreshTable(f"{self.name}_{table}")
        return self.spark.table(f"{self.name}_{table}")

    def append(self, table: str, df: DataFrame, dealt: bool = False) -> None:
        """Appends rows; dealt: whether they come partitioned into the table's buckets."""
        key = self.BUCKETED[table]
        df = df.select(*[c.name for c in self.spark.table(f"{self.name}_{table}").schema])
        df = df if dealt else df.repartition(self.buckets, key)
        df.write.mode("append").format("parquet").bucketBy(self.buckets, key).sortBy(key).saveAsTable(f"{self.name}_{table}")

    def close(self) -> None:
        """Forgets the names; the folder stays."""
        for table in self.schemas:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}_{table}")


def _rows(rows: DataFrame) -> DataFrame:
    """One row per id: (id, batch, addr, host, words, set, node); rows without address and set match nothing and are left out."""
    rows = rows.filter("id is not null and batch is not null").select("id", "batch", "addr", "host", "words")
    words = F.when((F.col("host") != "") & (F.size("words") > 0), F.col("words"))
    ordered = F.transform(F.sort_array(F.transform(words, lambda w: F.struct(F.xxhash64(w).alias("h"), w.alias("w")))), lambda s: s["w"])
    rows = rows.withColumn("addr", F.when(F.col("addr") != "", F.col("addr"))).withColumn("words", ordered)
    digest = F.unhex(F.md5(F.concat_ws(" ", "host", F.array_join("words", " "))))
    rows = rows.withColumn("set", F.when(F.col("words").isNotNull(), digest))
    node = F.unhex(F.md5(F.concat(F.coalesce("addr", F.lit("")), F.lit(" "), F.coalesce(F.hex("set"), F.lit("")))))
    rows = staged(rows.withColumn("node", node), "rows")
    # An id that comes again counts with its first batch; only such rows are moved for it.
    twice = staged(rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("id"), "twice")
    if twice.limit(1).count():
        first = rows.join(shuffled(twice), "id", "left_semi").groupBy("id").agg(F.min_by(F.struct(*rows.columns), F.struct("batch", "node")).alias("r")).select("r.*")
        rows = rows.join(shuffled(twice), "id", "left_anti").unionByName(first)
    return rows.filter("addr is not null or set is not null")


def _nodes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("batch", "node").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"), F.first("addr").alias("addr"), F.first("set").alias("set"))


def _sets(rows: DataFrame) -> DataFrame:
    return sized(rows.filter("set is not null").groupBy("set").agg(F.first("host").alias("host"), F.first("words").alias("words")))


def similar_sets(sets: DataFrame, share: float = SHARE) -> DataFrame:
    """(a, b) of all similar sets(sized) in both directions, and of each with itself."""
    several = sets.groupBy("host").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("host")  # a host with one set has no pair
    some = staged(sets.join(shuffled(several), "host", "left_semi"), "some")
    index = segment_index(some.withColumns({"batch": F.lit(""), "id": F.lit(0)}), share)
    hits = _hits(_probe_entries(some.select("set", "host", "words", "size"), "host", F.col("words"), share), index, share).filter("a <> b").select("a", "b").distinct()
    return _verified(hits, some, some, share).unionByName(sets.select(F.col("set").alias("a"), F.col("set").alias("b")))


def _settled(nodes: DataFrame, sets: DataFrame, share: float) -> DataFrame:
    """nodes(..., p) of several batches, p being the stored partner: with the partners among themselves.

    A node is accepted once no earlier neighbour is accepted, and repeats the earliest one that is; it waits while one that
    is earlier is open. Chains of repeats bound the rounds. A hub (address or word set) knows its earliest neighbours, so
    that the nodes of a hub never meet each other.
    """
    links = staged(similar_sets(sets, share), "links")
    # Nodes without a neighbour keep what they have; all neighbours of the others are among the others.
    addrs = nodes.filter("addr is not null").groupBy("addr").agg((F.count(F.lit(1)) > 1).alias("by_addr"))
    held = nodes.filter("set is not null").select("set").unionByName(links.filter("a <> b").select(F.col("a").alias("set")))
    held = held.groupBy("set").agg((F.count(F.lit(1)) > 1).alias("by_set"))
    marked = staged(nodes.join(shuffled(addrs), "addr", "left").join(shuffled(held), "set", "left").withColumn("linked", F.coalesce("by_addr", F.lit(False)) | F.coalesce("by_set", F.lit(False))), "marked")
    alone, nodes = marked.filter("not linked").select(*nodes.columns), marked.filter("linked").select(*nodes.columns)
    links = links.join(shuffled(nodes.select(F.col("set").alias("a")).distinct()), "a", "left_semi")
    state = nodes.withColumn("accepted", F.when(F.col("p").isNotNull(), F.lit(False)))
    while True:
        live = staged(state, "state")
        first = lambda c: [F.min(F.when(F.col("accepted"), F.struct("batch", "id"))).alias(f"q_{c}"), F.min(F.when(F.col("accepted").isNull(), F.col("batch"))).alias(f"open_{c}")]
        some = live.filter("accepted is null or accepted")
        by_addr = some.filter("addr is not null").groupBy("addr").agg(*first("addr"))
        own = some.filter("set is not null").groupBy(F.col("set").alias("b")).agg(*first("own"))
        by_set = links.join(shuffled(own), "b").groupBy(F.col("a").alias("set")).agg(F.min("q_own").alias("q_set"), F.min("open_own").alias("open_set"))
        state = live.join(shuffled(by_addr), "addr", "left").join(shuffled(by_set), "set", "left")
        q, wait = F.least("q_addr", "q_set"), F.coalesce(F.least("open_addr", "open_set") < F.col("batch"), F.lit(False))
        hit = F.coalesce(q["batch"] < F.col("batch"), F.lit(False))
        accepted = F.when(F.col("accepted").isNotNull(), F.col("accepted")).when(hit, False).when(wait, F.lit(None)).otherwise(True)
        partner = F.when(~F.coalesce(F.col("accepted"), F.lit(False)) & hit, F.least("p", q)).otherwise(F.col("p"))
        if not live.filter("accepted is null").limit(1).count():
            # All is decided: the earliest accepted neighbour of each repeat.
            return state.withColumn("p", partner).select(*nodes.columns).unionByName(alone)
        state = state.withColumn("accepted", accepted).select(*nodes.columns, "accepted")


def _step(nodes: DataFrame, sets: DataFrame, store: Store, share: float, fan: int, several: bool, first: bool) -> DataFrame:
    """The nodes of one or several batches with their partners p; what is accepted is appended to the store."""
    if first:
        met = nodes.withColumn("p", F.lit(None).cast(f"struct<batch: string, id: {dict(nodes.dtypes)['id']}>"))
    else:
        by_set = nearest_sets(sets, store.read("segments"), store.read("sets"), share, fan)
        old = store.read("nodes").filter("p is null and addr is not null")
        by_addr = nodes.filter("addr is not null").select("addr").distinct().join(shuffled(old.select("addr", F.struct("batch", "id").alias("q"))), "addr").groupBy("addr").agg(F.min("q").alias("q"))
        met = nodes.join(shuffled(by_addr), "addr", "left").join(shuffled(by_set), "set", "left").withColumn("p", F.least("q", "p")).drop("q")
    met = met.select("node", "n", "addr", "set", "batch", "id", "p")
    met = staged(_settled(met, sets, share) if several else met, "met")
    # Both sides are dealt to the buckets before they meet, so that each bucket is one file, whatever the number of shuffle partitions.
    new = met.filter("p is null and set is not null").select("set", "batch", "id").repartition(store.buckets, "set")
    new = new.groupBy("set").agg(F.min(F.struct("batch", "id")).alias("f")).select("set", "f.*")
    store.append("nodes", met)
    store.append("sets", sets.repartition(store.buckets, "set").join(shuffled(new), "set"), dealt=True)
    # The sets just appended: the files of earlier steps are passed over by their statistics.
    oldest = met.agg(F.min("batch")).first()[0]
    store.append("segments", segment_index(store.read("sets").filter(F.col("batch") >= oldest), share))
    return met


def _expanded(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    partners = nodes.filter("p is not null").select("batch", "node", "n", "p")
    heavy = heavy_keys(partners, rows.count())
    return split_join(rows.select("id", "batch", "node"), partners, ["batch", "node"], heavy).select("id", F.col("p.id").alias("repeats"))


def deduplicate_batch(rows: DataFrame, store: Store, share: float = SHARE, fan: int = FAN) -> DataFrame:
    """(id, repeats) of the rows (id, batch, addr, host, words) of a new batch that repeat an accepted row of an earlier one.

    Nothing but the store is read of earlier batches; what the batch brings is appended to it. rows may hold several
    batches, all later than those of the store.
    """
    rows = _rows(rows)
    batches = rows.select("batch").distinct().count()
    if not batches:
        return rows.select("id", F.col("id").alias("repeats"))
    first = not store.read("nodes").limit(1).count()
    return _expanded(rows, _step(staged(_nodes(rows), "nodes"), staged(_sets(rows), "sets"), store, share, fan, batches > 1, first))


def _steps(counts: list[tuple[str, int]], most: int) -> list[list[tuple[str, int]]]:
    """The batches (batch, rows) in turn: one a step, or several with `most` rows at most."""
    steps: list[list[tuple[str, int]]] = []
    for batch, n in counts:
        if not steps or sum(m for _, m in steps[-1]) + n > most:
            steps.append([])
        steps[-1].append((batch, n))
    return steps


def _pairs(sets: DataFrame, share: float) -> int:
    """Pairs of entries with one key in the index of sets(sized)."""
    index = segment_index(sets.withColumns({"batch": F.lit(""), "id": F.lit(0)}), share)
    n = F.col("n").cast("double")
    return int(index.groupBy("key").agg(F.count(F.lit(1)).alias("n")).agg(F.sum(n * (n - 1))).first()[0] or 0)


def deduplicate_history(rows: DataFrame, share: float = SHARE, fan: int = FAN, step_rows: int = STEP_ROWS, step_pairs: int = STEP_PAIRS) -> DataFrame:
    """(id, repeats): every row that repeats an accepted row, batch after batch over a store that begins empty.

    A step takes one batch, or several small ones up to step_rows rows or a part of all rows, and reads nothing but their rows and
    the store. A larger step whose segments hold more than step_pairs pairs a row is taken in steps of step_rows.
    """
    spark = rows.sparkSession
    rows = _rows(rows)
    counts = sorted(tuple(r) for r in rows.groupBy("batch").agg(F.count(F.lit(1))).collect())
    total = sum(n for _, n in counts)
    steps = _steps(counts, max(step_rows, total // STEPS))
    if not steps:
        return rows.select("id", F.col("id").alias("repeats"))
    where = spark.createDataFrame([(b, k) for k, s in enumerate(steps) for b, _ in s], "batch string, part int")  # as many rows as batches
    folder, parts = stage_path(spark, "parts"), rows.join(F.broadcast(where), "batch")
    parts.hint("rebalance", "part").write.partitionBy("part").parquet(folder)
    parts = spark.read.schema(parts.schema).parquet(folder)
    buckets = min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(12, total // BUCKET_ROWS))
    store = Store(spark, stage_path(spark, "store"), dict(rows.dtypes)["id"], buckets)
    first = True
    for k, s in enumerate(steps):
        mine = parts.filter(F.col("part") == k)
        sets, n = staged(_sets(mine), "sets"), sum(m for _, m in s)
        small = [s]
        if len(s) > 1 and n > step_rows and _pairs(sets, share) > step_pairs * n:
            small = _steps(s, step_rows)
        for t in small:
            if len(small) > 1:
                some = mine.filter(F.col("batch").isin([b for b, _ in t]))
                sets = staged(_sets(some), "sets")
            else:
                some = mine
            _step(staged(_nodes(some), "nodes"), sets, store, share, fan, len(t) > 1, first)
            first = False
    nodes = staged(store.read("nodes").filter("p is not null"), "repeats")
    store.close()
    return _expanded(parts, nodes)

"""Training-data operators on small fixtures: brute force, exact round trips, and the defined cases of the docstrings."""

import hashlib
import itertools
import random

import pytest
from pyspark.sql import functions as F

from quillmark.llm import copies, increment, mojibake, names, packing, tokens, topn, truncation

CLASH = "scope string, canon string, g string, s string, key string, n int, len int"  # names that operators use inside


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) if cols else tuple(r) for r in df.collect())


def test_copies(spark):
    data = [
        (1, 7, "http://a.org/x?b=1&c=2", "x"), (2, 7, " HTTP://A.ORG/x/?c=2;b=1 ", "x"), (3, 8, "http://a.org/x?b=1&c=2", "x"), (4, None, "http://a.org/x", "x"), (5, 7, None, "x"),
        (6, 7, "http://a.org/x?b=1&c=2", "x"), (7, 7, "http://a.org/x?b=1&&c=2;", "x"), (8, 7, "--", "x"), (9, 7, "!", "x"), (6, 7, "http://a.org/x?b=1&c=2", "x"),
    ]
    df = spark.createDataFrame(data, "id long, doc long, url string, canon string").withColumn("scope", F.lit(1)).withColumn("raw", F.lit("r"))
    assert rows(copies.format_links(df, "id", "url", "doc")) == [(1, 2), (1, 6), (1, 7), (8, 9)]
    assert rows(copies.format_links(df, "id", "url")) == [(1, 2), (1, 3), (1, 6), (1, 7), (8, 9)]
    got = {r.keep_id: r.copies for r in copies.format_groups(df, "id", "url", "doc").collect()}
    assert got == {1: 5, 3: 1, 8: 2}
    empty = df.filter("false")
    assert copies.format_links(empty, "id", "url").count() == copies.format_groups(empty, "id", "url").count() == 0


def test_copies_of_a_hot_address_and_long_text(spark):
    df = spark.range(6000).select("id", F.when(F.col("id") % 3 > 0, F.concat(F.lit("H"), F.repeat(F.lit("-"), (F.col("id") % 5).cast("int")))).otherwise(F.concat(F.lit("u"), F.col("id"))).alias("url"))
    assert copies.format_links(df, "id", "url").count() == 3999
    long = spark.createDataFrame([(1, "a" * 100_000 + "?x=1&y=2"), (2, "A" * 100_000 + "?y=2&x=1")], "id long, url string")
    assert rows(copies.format_links(long, "id", "url")) == [(1, 2)]


def test_top_n(spark):
    rng = random.Random(1)
    data = [(i, rng.choice([1, 1, 1, 2, 3, None]), rng.choice([0.0, -0.0, 1.5, 2.0, -1.0, float("nan"), None]), rng.choice([1, 2, None])) for i in range(4000)]
    df = spark.createDataFrame(data, "id long, g long, score double, rank int").withColumn("pos", F.lit(9)).withColumn("n", F.lit(1))
    best = {}
    for i, g, s, r in data:
        if g is not None and s is not None and s >= 0:
            best.setdefault(g, []).append((-(s + 0.0), r is None, r or 0, i))
    expected = sorted((g, k + 1, x[3]) for g, v in best.items() for k, x in enumerate(sorted(v)[:10]))
    assert rows(topn.top_n(df, "g", "score", "rank", "id", 10)) == expected
    assert topn.top_n(df.filter("false"), "g", "score", "rank", "id").count() == 0


def test_token_distance_and_assignment(spark):
    pairs = [("abcd", "abcd", True), ("abcd", "abdc", True), ("abcd", "abce", True), ("abcd", "abc", True), ("abcd", "bcda", False), ("abcd", "abxy", False)]
    df = spark.createDataFrame(pairs, "a string, b string, e boolean")
    assert all(r.e == r.g for r in df.select("e", names._one_edit(F.col("a"), F.col("b")).alias("g")).collect())
    assert names.assignment(("univ", "x"), ("x", "university"), names.word_cost) < 1
    assert names.assignment(("x", "y"), ("x",), names.word_cost) == float("inf")
    assert names.assignment(("hospital",), ("school",), names.word_cost) == float("inf")


def test_name_variants(spark):
    given = spark.createDataFrame([("Robert", "Bob"), ("Richard", "Rick"), ("Nicholas", "Nick"), ("Rebecca", "Becky")], "given_name string, nickname string")
    people = ["Tavolishi, Robert", "Bob Tavolishi", "Tavolishi RJ", "R. J. Tavolishi", "Robert J. Tavolishi", "TAVOLIHSI, ROBERT", "Nick Tavolishi", "Rick Kemosatu", "Kemosatu, Rebecca", "R. Kemosatu", "", "  ", "-"]
    df = spark.createDataFrame([(x,) for x in people], "name string")
    got = {r.name: r.entity for r in names.persons(df.filter("trim(name) <> ''"), given).collect()}
    one = {got[x] for x in people[:6]}
    assert len(one) == 1 and None not in one
    assert got["Nick Tavolishi"] not in one and got["R. Kemosatu"] is None
    orgs = ["Dugasonville University", "Univ. of Dugasonville", "DUGASONVILLE UNIVERSITY", "Dugasonvlile University (DU)", "Dugasonville Medical School", "Dugasonville Med Sch.", "Dugasonville Technical University"]
    org = {r.name: r.entity for r in names.organisations(spark.createDataFrame([(x,) for x in orgs], "name string")).collect()}
    assert len({org[x] for x in orgs[:4]}) == 1 and len({org[x] for x in orgs[4:6]}) == 1 and len(set(org.values())) == 3
    reg = spark.createDataFrame([(" a ", None), (None, "b"), ("", "a")], "p string, q string")
    assert rows(names.spellings([(reg, "p"), (reg, "q")])) == [("a", 2), ("b", 1)]
    nothing = df.filter("false")
    assert names.spelling_links(names.persons(nothing, given)).count() == names.spelling_links(names.organisations(nothing)).count() == 0


def test_truncation(spark):
    whole = ["The atlas is hosted by a team of curators.", "We filtered cell lines from the mouse.", "Users may submit spike trains."]
    data = [(i, "a", whole[i % 3]) for i in range(600)]
    data += [(1000, "a", "The atlas is hosted by a te"), (1001, "a", "Users may submit spike trains. We filt"), (1002, "a", "Users may sub…"), (1003, "a", "Database home page"), (1004, "b", None), (1005, None, ""), (1006, "a", "Users may submit spike trains. W")]
    data += [(2000 + i, "a", "Database home page") for i in range(30)]
    df = spark.createDataFrame(data, "id long, batch string, t string").withColumn("len", F.lit(1)).withColumn("field", F.lit("z"))
    v = truncation.values(df, "x.t", "id", "t", "batch")
    assert [r[0] for r in rows(truncation.find_cut(v), "id")] == [1000, 1001, 1002, 1006]
    rate = {r.source: (r["values"], r.cut) for r in truncation.cut_rates(v).collect()}
    assert rate == {"a": (635, 4)}
    assert truncation.find_cut(v.filter("false")).count() == 0


def _history(rng):
    words = [f"w{i}" for i in range(14)]
    out = []
    for i in range(260):
        w = sorted(set(rng.sample(words, rng.randint(3, 12)))) if rng.random() < 0.9 else None
        out.append((i, f"2013{rng.randint(1, 9):02d}", rng.choice([None, "", *[f"a{k}" for k in range(90)]]), rng.choice(["h1", "h1", "h2", ""]), w))
    return out


def _brute(data, share=0.8):
    accepted, out = [], []
    for b in sorted({r[1] for r in data}):
        new = []
        for r in (r for r in data if r[1] == b):
            hit = []
            for a in accepted:
                same = bool(r[2]) and r[2] == a[2]
                if not same and r[3] and r[3] == a[3] and r[4] and a[4]:
                    x, y = set(r[4]), set(a[4])
                    same = len(x & y) >= share * len(x | y) - 1e-9
                if same:
                    hit.append((a[1], a[0]))
            if hit:
                out.append((r[0], min(hit)[1]))
            else:
                new.append(r)
        accepted += new
    return sorted(out), accepted


@pytest.mark.parametrize("seed", [1, 2])
def test_history_against_brute_force(spark, seed):
    data = _history(random.Random(seed))
    df = spark.createDataFrame([*data, data[0], (None, "201301", "a", "h", None), (999, None, "a", "h", None)], "id long, batch string, addr string, host string, words array<string>")
    for step in (increment.STEP_ROWS, 60) if seed == 1 else (60,):
        assert rows(increment.deduplicate_history(df, step_rows=step), "id", "repeats") == _brute(data)[0]


def test_steps_do_not_grow_with_the_batches(spark, monkeypatch):
    data = [(r[0], f"{r[1]}{r[0] % 3}", *r[2:]) for r in _history(random.Random(5)) if r[1] <= "201302"]
    df = spark.createDataFrame(data, "id long, batch string, addr string, host string, words array<string>")
    taken, step = [], increment._step
    monkeypatch.setattr(increment, "STEPS", 2)
    monkeypatch.setattr(increment, "_step", lambda *a: (taken.append(1), step(*a))[1])
    assert rows(increment.deduplicate_history(df, step_rows=1), "id", "repeats") == _brute(data)[0]
    assert len(taken) <= 2 * increment.STEPS + 1 < len({r[1] for r in data}) == 6
    # Segments with too many pairs: in small steps, with the same rows.
    taken.clear()
    assert rows(increment.deduplicate_history(df, step_rows=1, step_pairs=-1), "id", "repeats") == _brute(data)[0]
    assert len(taken) == 6


def test_batch_after_batch_gives_the_same(spark, tmp_path):
    data = [r for r in _history(random.Random(3)) if r[1] <= "201303"]
    schema = "id long, batch string, addr string, host string, words array<string>"
    folder, got, sizes = f"file://{tmp_path}/store", [], []
    for b in sorted({r[1] for r in data}):
        store = increment.Store(spark, folder)  # opened anew: all that is known lies in the folder
        got += rows(increment.deduplicate_batch(spark.createDataFrame([r for r in data if r[1] == b], schema), store), "id", "repeats")
        sizes.append(store.read("segments").count())
    assert sorted(got) == _brute(data)[0]
    assert sizes == sorted(set(sizes))  # each batch only appends
    store = increment.Store(spark, folder)
    built = increment.segment_index(store.read("sets")).select("key", "set", "seg")
    assert rows(built) == rows(store.read("segments").select("key", "set", "seg"))
    whole = increment.Store(spark, folder + "2")
    assert rows(increment.deduplicate_batch(spark.createDataFrame(data, schema), whole), "id", "repeats") == sorted(got)


def test_no_step_broadcasts_what_grows(spark, monkeypatch):
    """Probes are exploded and texts stored compressed, so that Spark takes them for small: the joins of a step don't ask it."""
    data = [r for r in _history(random.Random(6)) if r[1] <= "201304"]
    df = spark.createDataFrame(data, "id long, batch string, addr string, host string, words array<string>")
    joins, stage, append = [], increment.staged, increment.Store.append
    seen = lambda d: joins.extend(x for x in d._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join " in x)
    monkeypatch.setattr(increment, "staged", lambda d, *a: (seen(d), stage(d, *a))[1])
    monkeypatch.setattr(increment.Store, "append", lambda self, table, d, *a, **k: (seen(d), append(self, table, d, *a, **k))[1])
    assert rows(increment.deduplicate_history(df, step_rows=100), "id", "repeats") == _brute(data)[0]
    assert len(joins) > 20 and not [x for x in joins if "strategy=merge" not in x]


def test_a_bucket_is_a_file(spark, tmp_path):
    """A step leaves a file a bucket, not one for each bucket and shuffle partition: the driver lists them all."""
    df = spark.createDataFrame([r for r in _history(random.Random(7)) if r[1] == "201301"], "id long, batch string, addr string, host string, words array<string>")
    store = increment.Store(spark, f"file://{tmp_path}/store", buckets=3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        increment.deduplicate_batch(df, store).count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {t: len(list((tmp_path / "store" / t).glob("*.parquet"))) for t in store.BUCKETED} == {"nodes": 3, "sets": 3, "segments": 3}


@pytest.mark.parametrize("seed", [4])
def test_hot_segments_are_refined_without_loss(spark, seed):
    rng = random.Random(seed)
    common = [f"c{k:02d}" for k in range(16)]
    data = []
    for i in range(240):  # texts of one host that share most of their words; a third is all but equal
        own = [f"w{rng.randint(0, 30)}" for _ in range(rng.randint(1, 2) if i % 3 == 0 else rng.randint(3, 8))]
        data.append((i, f"2013{rng.randint(1, 4):02d}", None, "h", sorted({*common, *own})))
    df = spark.createDataFrame(data, "id long, batch string, addr string, host string, words array<string>")
    assert rows(increment.deduplicate_history(df, fan=5, step_rows=1), "id", "repeats") == _brute(data)[0]


def test_index_is_linear_and_probes_of_unlike_texts_hit_little(spark):
    sets = lambda n, m, seed: [(bytes([seed]) + i.to_bytes(4, "big"), "h", [f"w{x}" for x in random.Random(seed * 10**6 + i).sample(range(2000), m)], "1", i) for i in range(n)]
    schema = "set binary, host string, words array<string>, batch string, id long"
    entries = [increment.segment_index(increment.sized(spark.createDataFrame(sets(1, m, 1), schema))).count() for m in (100, 200, 400, 800)]
    assert entries == [26, 51, 101, 201]
    hits = []
    for n in (1500, 3000):
        old, new = spark.createDataFrame(sets(n, 14, 1), schema), spark.createDataFrame(sets(n, 14, 2), schema)
        probe = increment._probe_entries(new.withColumn("size", F.size("words")), "host", F.col("words"), 0.8)
        hits.append(increment._hits(probe, increment.segment_index(increment.sized(old)), 0.8).count())
    assert hits[1] <= 2 * max(hits[0], 50)


def test_history_of_nothing_and_hosts(spark):
    schema = "id long, batch string, addr string, host string, words array<string>"
    assert increment.deduplicate_history(spark.createDataFrame([], schema)).count() == 0
    urls = [("HTTP:// WWW.A-B.Example.org/x", "a-b.example.org"), ("(http://www.a.org),", "a.org"), ("a.org", "a.org"), ("https://x.y:80/z", "x.y"), (None, None), ("", "")]
    df = spark.createDataFrame(urls, "u string, h string")
    assert all(r.g == r.h for r in df.select("h", increment.host(F.col("u")).alias("g")).collect())


def test_encoding_round_trip(spark):
    tiktoken = pytest.importorskip("tiktoken")
    ranks, back = tokens.vocabulary(f"{tokens.TOKENIZERS}/{tokens.VOCABULARY}")
    other = tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["", None, "Hello  world\n\n it's 123", "<|endoftext|> as text", "aaaaaaaaaaaaaaa", "naïve 🧠 Данные 解析", "x" * 20_000, " \t ", "Hello  world\n\n it's 123", "abc" * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("ids", F.lit("clash"))
    got = {r.doc_id: r.ids for r in tokens.encode_corpus(df.drop("ids"), "doc_id", "text").collect()}
    for i, t in enumerate(texts):
        assert got[i] == other.encode_ordinary(t or "")
        assert b"".join(back[k] for k in got[i]).decode("utf-8") == (t or "")
    assert tokens.encode_corpus(df.drop("ids").filter("false"), "doc_id", "text").count() == 0


def test_packing(spark):
    rng = random.Random(4)
    texts = ["word " * rng.choice([0, 1, 3, 40, 90]) for _ in range(400)] + [None, "", "word " * 700]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("size", F.lit("clash")).withColumn("key", F.lit(0))
    out = packing.pack(df, "doc_id", "text", capacity=100, stretch=150).collect()
    by = {}
    for r in out:
        by.setdefault(r.container, []).append((r.offset, r.length))
    for v in by.values():  # no overlap, no gap, never over capacity
        at = 0
        for o, n in sorted(v):
            assert o == at
            at += n
        assert at <= 100
    sizes = {r.doc_id: r.n for r in df.select("doc_id", tokens.token_count(F.col("text")).alias("n")).collect()}
    for i in sizes:
        pieces = sorted((r.piece, r.start, r.length) for r in out if r.doc_id == i)
        assert sum(p[2] for p in pieces) == sizes[i] and len(pieces) == max(1, -(-sizes[i] // 100))
    f = packing.fill(packing.pack(df, "doc_id", "text", capacity=100), 100).first()
    large, middle = sum(n > 50 for n in sizes.values() if n <= 100), sum(25 < n <= 50 for n in sizes.values())
    assert f.containers <= large + -(-middle // 2) + 8 + 1  # the longest text fills seven and a rest
    assert packing.pack(df.filter("false"), "doc_id", "text", 100).count() == 0


def test_packing_is_repeatable_and_splits_dense_cells(spark):
    texts = ["the same words again"] * 500 + [f"text {i} " * (i % 9) for i in range(500)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    once = rows(packing.pack(df.repartition(3), "doc_id", "text", 64, stretch=100))
    assert once == rows(packing.pack(df.repartition(7, "text"), "doc_id", "text", 64, stretch=100))
    parts = packing.stretches([(0, 30), (1, 500), (2, 40), (3, 70)], 100)
    assert parts == [(0, 0, 1), (1, 1, 5), (2, 6, 1), (3, 7, 1)]
    assert len({c >> 32 for *_, c, _ in once}) >= 10


def test_hilbert_neighbours():
    import numpy as np

    p = np.array(list(itertools.product(range(8), repeat=2)))
    k = packing.hilbert(p, bits=3)
    assert sorted(k) == list(range(64))
    q = p[np.argsort(k)]
    assert (np.abs(np.diff(q, axis=0)).sum(axis=1) == 1).all()  # the curve moves to a neighbour each time


def _layers(text, n):
    for _ in range(n):
        text = text.encode().decode("latin-1")
    return text


def test_garbled_text(spark):
    clean = ["Levels of naïve T cells rose at 37 °C.", "Müller cells “gold standard” ≥ 95 %", "Данные были получены для коры мозга мыши", "A coleção não está incluída", "plain text", "façade – 5 µm", "COLEÇÃO DE AMOSTRAS"]
    data = [(i, "s", clean[i % len(clean)]) for i in range(700)]
    broken = {
        1001: (clean[0].encode().decode("latin-1"), clean[0]), 1002: (clean[5].encode().decode("cp437"), clean[5]), 1003: (clean[0].encode().decode("mac_roman"), clean[0]),
        1004: (clean[0].encode().decode("latin-1").encode().decode("latin-1"), clean[0]), 1005: (clean[2].encode("koi8_r").decode("cp1251"), clean[2]), 1006: (clean[2].encode("cp1251").decode("latin-1"), clean[2]),
        1007: ("Levels of na�ve T cells", ""), 1008: (_layers("façade – 5 µm of stone", 5), "façade – 5 µm of stone"),
    }
    data += [(i, None, b) for i, (b, _) in broken.items()] + [(2000, "s", None), (2001, None, ""), (2002, "s", "word " * 20_000)]
    df = spark.createDataFrame(data, "doc_id long, source string, text string").withColumn("chain", F.lit("clash")).withColumn("id", F.lit(1))
    got = {r.id: r.restored for r in mojibake.repair(df, "doc_id", "text", "source").collect()}
    assert got == {i: o for i, (_, o) in broken.items()}
    assert mojibake.repair(df.filter("false"), "doc_id", "text", "source").count() == 0
    assert hashlib.md5(got[1001].encode()).hexdigest() == hashlib.md5(clean[0].encode()).hexdigest()


def test_single_words_of_a_garbled_source(spark):
    clean = ["the naïve model", "a façade of stone", "Müller cells", "the rôle of cells", "a café nearby"]
    data = [(i, "s", clean[i % 5] + f" {i}") for i in range(3000)] + [(5000 + i, "t", (clean[i % 5] + f" {i}").encode("cp1252").decode("mac_roman")) for i in range(40)]
    df = spark.createDataFrame(data, "doc_id long, source string, text string")
    got = {r.id: r.restored for r in mojibake.repair(df, "doc_id", "text", "source").collect()}
    assert got == {5000 + i: clean[i % 5] + f" {i}" for i in range(40)}


def test_names_of_many_words_are_aligned():
    rng = random.Random(5)
    for n in range(1, 7):
        for _ in range(200):
            c = {(x, y): rng.choice([0.0, 0.2, 0.4, 0.6, float("inf")]) for x in range(n) for y in range(n)}
            cost = lambda x, y: c[x, y]  # noqa: B023, E731
            a = tuple(range(n))
            assert names._matching(a, a, cost) == pytest.approx(names.assignment(a, a, cost))
    long = tuple(f"word{'abcdefghijklmnopq'[k]}" for k in range(16)) + ("university",)
    assert names.assignment(long, ("univ", *long[:-1]), names.word_cost) == pytest.approx(0.2)
    assert names.assignment(long, ("other", *long[:-1]), names.word_cost) == float("inf")

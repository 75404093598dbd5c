"""General operators and functions: literal cases, invariants, defined results of odd input."""

import datetime as dt
import random
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from quillmark.functions import dates, text, url, vectors
from quillmark.operators import history, lookup, packed, search, skew, timestamps

DATA = "/root/testdata/sf0.001"


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if v is None or isinstance(v, str) else 'int' if isinstance(v, int) else 'array<double>'}" for k, v in values.items()))
    return df.select(column).first()[0]


@pytest.mark.parametrize(
    ("f", "given", "expected"),
    [
        (url.registry_form, " HTTP://A.org/ ", "http://a.org"), (url.registry_form, "a.org", "http://a.org"), (url.registry_form, "http://a.org//", "http://a.org/"),
        (url.extraction_form, "http://A.org/x.", "http://A.org/x"), (url.extraction_form, "http://a.org./", "http://a.org"), (url.host_form, "http://www.a.org/", "a.org"),
        (url.is_bad, "http://x.org/library", True), (url.is_bad, "www.x.org", True), (url.is_bad, "http://x.org/a", False),
        (dates.file_date, "X_2012_May_3_33(5)_1-2.nxml", "2012-05-03"), (dates.file_date, "none.nxml", None),
        (lambda c: dates.update_year(c, 2026), "Last updated 2012. Update of 2014 and 2013. In 2020. update 2031", 2014),
        (lambda c: dates.repaired_year(c, 2026), "updated on 3 May 2011, 2012", 2012), (lambda c: dates.repaired_year(c, 2026), "Copyright 2009 - 2013", 2013),
        (lambda c: text.shingles(c, 2), "a b c", ["a|b|", "b|c|"]), (text.collapse_space, "a \t\n b", "a b"), (text.strip_tags, "<b>x</b>", "x"),
        (text.drop_supplementary, "a-b\U0001f600c", "a-bc"), (text.clean_expansion, "of magnetic imaging -", "magnetic imaging"), (text.content_bigrams, "red cells, blue cells of the mouse", ["red cells", "blue cells"]),
    ],
)
def test_functions(spark, f, given, expected):
    assert one(spark, f(F.col("x")), x=given) == expected


def test_variants(spark):
    got = one(spark, url.variants(F.col("x")), x="http://www.a.org")
    assert [r.variant for r in got] == ["http://www.a.org", "http://a.org", "http://www.a.org/index.html"]


@pytest.mark.parametrize(("term", "inside", "expected"), [("Image", "ImageJ tool", False), ("ImageJ", "ImageJ2", True), ("ImageJ", "the ImageJ", True), ("mage", "Image", False)])
def test_word_boundary(spark, term, inside, expected):
    assert one(spark, text.at_word(F.col("a"), F.col("b")), a=term, b=inside) is expected


@pytest.mark.parametrize(("a", "b", "expected"), [("Cell", "Cell Biology", True), ("Cell Biology", "Sell Biology", True), ("Cell", "Tissue", False)])
def test_similar_titles(spark, a, b, expected):
    assert one(spark, text.similar_titles(F.col("a"), F.col("b")), a=a, b=b) is expected


def test_divergence(spark):
    p, q = [0.5, 0.5, 0.0], [0.0, 0.0, 1.0]
    assert one(spark, vectors.js_bits(F.col("a"), F.col("b")), a=p, b=p) == pytest.approx(0)
    assert one(spark, vectors.js_bits(F.col("a"), F.col("b")), a=p, b=q) == pytest.approx(1)
    assert one(spark, vectors.cosine(F.col("a"), F.col("b")), a=[0.0, 0.0], b=[1.0, 1.0]) == 0


@pytest.mark.parametrize(("events", "run"), [("DDDU", 3), ("UDDD", None), ("DUDD", None), ("DDDD", 4), ("", None)])
def test_down_runs(spark, events, run):
    n = len(events)
    df = spark.createDataFrame([(1, n - i, e == "U") for i, e in enumerate(events)], "site int, t int, up boolean")
    got = history.down_runs(df, "site", [F.col("t")], F.col("up")).collect()
    assert (got[0].run if got else None) == run


def test_semi_and_anti_joins_make_up_the_input(spark):
    rows = spark.range(100).select("id", (F.col("id") % 7).alias("k"))
    keys = spark.range(3).select(F.col("id").alias("k"))
    assert rows.join(keys, "k", "left_semi").count() + rows.join(keys, "k", "left_anti").count() == 100


def test_heavy_keys_are_bounded_in_number_not_by_a_share():
    assert skew.HEAVY_KEYS * 16 < 2 * 1024**2  # bytes broadcast


def test_split_join_equals_a_join(spark):
    rows = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"))
    dim = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    heavy = skew.heavy_keys(dim, 5000, least=100)
    assert heavy.count() >= 1
    got = skew.split_join(rows, dim, ["k"], heavy, rows=100)
    assert sorted(map(tuple, got.select("id", "n").collect())) == sorted(map(tuple, rows.join(dim, "k").select("id", "n").collect()))


def test_upsert_and_sync(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, v string")
    new = spark.createDataFrame([(2, None), (4, "d")], "id int, v string")
    assert sorted(map(tuple, lookup.upsert(old, new, ["id"], ["v"]).collect())) == [(1, "a"), (2, None), (3, None), (4, "d")]
    assert sorted((r.id, r.action) for r in lookup.sync(new, old, "id", ["v"]).collect()) == [(1, "missing"), (2, "update"), (3, "missing"), (4, "insert")]


PACKED = [
    ("a; b ,c", ",;|", ["a", "b", "c"]), ('"a, b",c', ",;|", ["a, b", "c"]), ('"say ""hi""" | x', ",;|", ['say "hi"', "x"]), ("a;;b; ", ",;|", ["a", "b"]), ("a\nb\tc", ",;|", ["a", "b", "c"]),
    ("Models, Animal; Sleep", ";|", ["Models, Animal", "Sleep"]), ("3D/4D viewer, time-series", ",;|", ["3D/4D viewer", "time-series"]), ("a; a", ";", ["a", "a"]), ('"open; b', ";", ['"open', "b"]), ("one", ";", ["one"]), (" ", ";", []), ('""; x', ";", ["x"]),
]


@pytest.mark.parametrize(("field", "seps", "expected"), [*PACKED, ('a "b; c" d; e', ";", ['a "b; c" d', "e"]), ("a\u00a0;\u2028b", ";", ["a", "b"])])
def test_packed_fields(spark, field, seps, expected):
    assert [p for p, _ in packed.split_quoted(field, seps)] == expected
    df = spark.createDataFrame([(1, field)], "id long, f string")
    assert [r.piece for r in packed.unpack(df, "id", {"f": seps}).orderBy("pos").collect()] == expected


def test_packed_tables(spark):
    df = spark.createDataFrame([(1, "a; b"), (2, None), (3, ""), (4, "c"), (5, "x;" * 20_000), (1, "a; b")], "id long, f string").withColumn("pos", F.lit("clash")).withColumn("v", F.lit(1))
    got = packed.unpack(df, "id", {"f": ";"}, least=2)
    assert {(r.id, r.n) for r in got.groupBy("id").agg(F.count(F.lit(1)).alias("n")).collect()} == {(1, 4), (5, 20_000)}
    for seps in (";", (";", ",")):
        assert packed.unpack(df.filter("false"), "id", {"f": seps}).count() == 0


def test_the_dictionary_decides_on_weak_separators(spark, monkeypatch):
    data = ["Cells, Animal; Sleep", "Sleep|Cells, Animal", "Cells, Animal", "Sleep; Mice", "Mice, Sleep, Rats", "Rats", "Rats; Mice; Sleep", '"Mice, Sleep"', "Sleep", "Mice", "Mice, Cells, Animal", None, "Rats,, Mice;"]
    data += ["Sleep; Mice; Rats"] * 20
    df = spark.createDataFrame(list(enumerate(data)), "id long, f string")
    expected = {0: ["Cells, Animal", "Sleep"], 2: ["Cells, Animal"], 4: ["Mice", "Sleep", "Rats"], 7: ["Mice, Sleep"], 10: ["Mice", "Cells, Animal"], 12: ["Rats", "Mice"]}
    for shard in (packed.SHARD_BYTES, 16):  # one automaton, or many
        monkeypatch.setattr(packed, "SHARD_BYTES", shard)
        got = {}
        for r in packed.unpack(df, "id", {"f": (";|", ",")}).orderBy("id", "pos").collect():
            got.setdefault(r.id, []).append(r.piece)
        assert {i: got[i] for i in expected} == expected
    off = {r.id for r in packed.unpack(df, "id", {"f": (";|", ",")}, guided=False).filter("piece = 'Cells'").collect()}
    assert off == {0, 1, 2, 10}


def test_the_dictionary_decides_on_the_tables(spark):
    """Whole tables: which headings come out otherwise without the dictionary."""
    from quillmark.plans.general import pieces

    on, off = (pieces(spark, DATA, 1, guided=g).filter("tbl = 'rd_paper_reference'") for g in (True, False))
    headings = on.filter("piece like '%, %'").select("id").distinct().count()
    changed = on.exceptAll(off).select("id").distinct().count()
    assert changed >= headings * 0.9 > 50


STAMPS = [
    ("2007-01-13T20:47:37", "1", "2007-01-14T01:47:37Z"), ("2007-04-16 02:33:10 Asia/Tokyo", "1", "2007-04-15T17:33:10Z"), ("2007-03-03 16:04:22 America/New_York", "1", "2007-03-03T21:04:22Z"),
    ("Mon, 14 Jan 2008 11:00:58 +0530", "2", "2008-01-14T05:30:58Z"), ("03/04/2010", "1", "2010-03-04"), ("03/04/2010", "2", "2010-04-03"), ("31.06.2012", "2", None), ("02.01.2011", "1", "2011-01-02"),
    ("13/02/2010", "1", None), ("2007-349", "1", "2007-12-15"), ("2008-366", "1", "2008-12-31"), ("2007-366", "1", None), ("1174044798", "1", "2007-03-16T11:33:18Z"), ("1169739418846", "1", "2007-01-25T15:36:58Z"),
    ("Dec. 10, 2008", "1", "2008-12-10"), ("10Feb2011", "1", "2011-02-10"), ("2007 Mar 1", "1", "2007-03-01"), ("01/2007", "1", "2007-01"), ("April 2007", "2", "2007-04"), ("2007", "1", "2007"), ("0000-00-00", "1", None),
    ("20070131 170913", "2", "2007-01-31T16:09:13Z"), ("20070101T033252Z", "1", "2007-01-01T03:32:52Z"), ("2008-02-18 12:41:19 AM", "3", "2008-02-18T00:41:19Z"), ("2007-02-14 16:34:46 EST", "2", "2007-02-14T21:34:46Z"),
    ("2014-10-26 02:30:00", "2", "2014-10-26T00:30:00Z"), ("2014-03-30 02:30:00", "2", "2014-03-30T01:30:00Z"), ("unknown", "1", None), ("", "1", None), (None, "1", None), ("2007-01-01 25:00:00", "1", None), ("2007-01-01 10:00:00 Mars/Base", "1", None),
    ("2012-13-05", "1", None), (" 2007-1-16 ", "1", "2007-01-16"),
]


def _locale(spark):
    return spark.createDataFrame([("1", "America/New_York", "mdy"), ("2", "Europe/Berlin", "dmy"), ("3", "UTC", "ymd")], "source string, time_zone string, day_order string")


def test_timestamps(spark):
    df = spark.createDataFrame([(i, v, s) for i, (v, s, _) in enumerate(STAMPS)], "id int, value string, source string").withColumn("norm", F.lit("clash"))
    got = {r.id: r for r in timestamps.normalise(df, _locale(spark), ["id"]).collect()}
    assert len(got) == len(STAMPS)
    for i, (v, s, expected) in enumerate(STAMPS):
        assert (v, s, got[i].norm) == (v, s, expected)
        assert got[i].status == ("unreadable" if expected is None else "read")
    assert timestamps.normalise(df.filter("false"), _locale(spark), ["id"]).count() == 0


def test_local_times_against_zoneinfo(spark):
    zone = ZoneInfo("Europe/Berlin")
    local = [dt.datetime(2014, 3, 29) + dt.timedelta(hours=h) for h in range(60)] + [dt.datetime(2014, 10, 25) + dt.timedelta(minutes=37 * h) for h in range(90)]
    df = spark.createDataFrame([(i, f"{t:%Y-%m-%d %H:%M:%S}", "2") for i, t in enumerate(local)], "id int, value string, source string")
    got = {r.id: r.norm for r in timestamps.normalise(df, _locale(spark), ["id"]).collect()}
    for i, t in enumerate(local):  # fold 0: the earlier instant; in a gap zoneinfo moves forward by the gap as well
        assert got[i] == f"{t.replace(tzinfo=zone).astimezone(dt.UTC):%Y-%m-%dT%H:%M:%SZ}"


def test_day_order_is_learned_or_marked(spark):
    sure = [(i, f"{13 + i % 15}/{1 + i % 12}/2010", "new") for i in range(200)]
    df = spark.createDataFrame([*sure, (1000, "03/04/2010", "new"), (1001, "03/04/2010", "other"), (1002, "05/05/2010", "other")], "id int, value string, source string")
    got = {r.id: (r.norm, r.status) for r in timestamps.normalise(df, _locale(spark), ["id"]).filter("id >= 1000").collect()}
    assert got == {1000: ("2010-04-03", "read"), 1001: (None, "ambiguous"), 1002: ("2010-05-05", "read")}


def test_known_orders_are_priors_and_the_values_of_a_source_decide_without_them(spark):
    """On the whole table: what the mixture decides, with and without the publishers' known orders."""
    from quillmark.plans.general import dates_of, orders

    data = "/root/testdata/sf0.01"  # the smallest has four such values
    rows_, known = dates_of(spark, data), orders(spark, data)
    slash = F.col("value").rlike("^ *(0?[1-9]|1[0-2])/(0?[1-9]|1[0-2])/[0-9]{4} *$")
    both = {}
    for name, locale in (("known", known), ("learned", known.withColumn("day_order", F.lit(None).cast("string")))):
        got = timestamps.normalise(rows_, locale, ["tbl", "id"])
        assert got.count() == rows_.count()
        both[name] = {(r.tbl, r.id): (r.norm, r.status) for r in got.filter(slash).collect()}
        assert got.filter("status = 'read' and not posterior >= 0.9").count() == 0
    assert len(both["known"]) > 10 and {s for _, s in both["known"].values()} == {"read"}
    assert both["learned"] == both["known"]  # enough values of each source have one reading alone
    off = timestamps.normalise(rows_, known.withColumn("day_order", F.lit(None).cast("string")), ["tbl", "id"], rounds=0)
    assert off.filter(slash).filter("status = 'ambiguous'").count() > 0.6 * len(both["known"])  # all but those with one number for day and month
    contrary = spark.createDataFrame([(i, "25/12/2010", "1") for i in range(50)] + [(99, "03/04/2010", "1")], "id int, value string, source string")
    got = {r.id: (r.norm, r.status) for r in timestamps.normalise(contrary, _locale(spark), ["id"]).collect()}
    assert got[0] == (None, "unreadable") and got[99] == ("2010-03-04", "read")
    odd = spark.createDataFrame([(1, "13/02/2010", None), (2, "14/02/2010", None), (3, "03/02/2010", None), (4, None, None), (4, None, None)], "id int, value string, source string")
    got = timestamps.normalise(odd, _locale(spark), ["id"])
    assert got.count() == 5 and got.filter("id = 3").first().norm == "2010-02-03"


def test_numbered_equals_row_number(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, F.lit(None)).otherwise((F.col("id") % 11).cast("string")).alias("k"))
    got = sorted((r.k or "", r.n) for r in skew.numbered(df, "k", "id", "n").collect())
    sizes = {r.k or "": r["count"] for r in df.groupBy("k").count().collect()}
    assert got == sorted((k, i + 1) for k, n in sizes.items() for i in range(n))


@pytest.mark.parametrize(
    ("link", "page", "expected"),
    [("x.html", "http://a.org/d/p.html", "http://a.org/d/x.html"), ("/x", "http://a.org/d/p", "http://a.org/x"), ("http://b.org", "http://a.org", "http://b.org"), ("//c.org/x", "https://a.org/", "https://c.org/x"), ("x", "http://a.org", "http://a.org/x")],
)
def test_resolve(spark, link, page, expected):
    assert one(spark, url.resolve(F.col("a"), F.col("b")), a=link, b=page) == expected


def test_redirects(spark):
    assert one(spark, url.redirects_away(F.col("a"), F.col("b")), a="http://www.a.org/", b="https://a.org") is False
    assert one(spark, url.redirects_away(F.col("a"), F.col("b")), a="http://a.org", b="http://b.org") is True


def test_uniqueness_and_failures(spark):
    search.assert_unique(spark.range(3), ["id"])
    with pytest.raises(ValueError, match="isn't unique"):
        search.assert_unique(spark.range(3).union(spark.range(1)), ["id"])
    assert one(spark, search.temporary_failure(F.col("a")), a="Peer not authenticated") is True
    assert one(spark, search.temporary_failure(F.col("a")), a="404 Not Found") is False


def test_annotations_of_names_of_any_length(spark):
    long = " ".join(f"w{k}" for k in range(40))
    names = spark.createDataFrame([("Cell Atlas", 1), (long, 2), ("Cell", 3), ("...", 4)], "name string, key int")
    docs = spark.createDataFrame([(1, "The cell atlas; a CELL"), (2, f"x {long.upper()} y"), (3, long[:-3]), (4, None)], "id int, t string")
    assert sorted(map(tuple, search.annotate(docs, "id", "t", names).collect())) == [(1, 1, 1), (1, 3, 1), (1, 3, 4), (2, 2, 1)]
    assert search.annotate(docs, "id", "t", names.filter("key = 4")).count() == 0


def test_contained_against_brute_force(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("ab.") for _ in range(rng.randint(0, 24))) for _ in range(300)]
    values, names = [*words[:150], None, "x"], [(w, i) for i, w in enumerate(words[130:])] + [("x", 900), (None, 901)]
    least = {}
    for w, i in names:
        least[w] = min(i, least.get(w, i))
    expected = {}
    for v in {v for v in values if v is not None}:
        hit = [(abs(len(v) - len(w)), i) for w, i in least.items() if w is not None and (v == w or (len(w) >= 4 and w in v) or (len(v) >= 4 and v in w))]
        if hit:
            expected[v] = min(hit)[1]
    got = search.contained(spark.createDataFrame([(v,) for v in values], "value string"), spark.createDataFrame(names, "name string, key int"))
    assert dict(map(tuple, got.collect())) == expected


def test_contained_of_long_strings(spark):
    """The pieces of a string grow with its length, not with its square, in which they would fill any memory here."""
    rng = random.Random(6)
    long = "".join(rng.choice("abcdefghij") for _ in range(8_000))
    values, names = [(long,), (long[300:1300],)], [(long[7000:7050], 1), ("k" + long[40:90], 2), (long[:6_000], 3)]
    got = search.contained(spark.createDataFrame(values, "value string"), spark.createDataFrame(names, "name string, key int"))
    assert sorted(map(tuple, got.collect()), key=lambda r: len(r[0])) == [(long[300:1300], 3), (long, 3)]


def test_contained_broadcasts_no_exploded_pieces(spark):
    """Names of a few bytes in their file have a hundred times as many pieces: only what is bounded is broadcast, the buckets of counts and the pieces of names."""
    got = search.contained(spark.createDataFrame([("abcdefgh",)], "value string"), spark.createDataFrame([("bcdef", 1)], "name string, key int"))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    joins = [x for x in plan.splitlines() if "Join " in x]
    assert joins and all("strategy=" in x for x in joins), plan
    assert all("bucket" in x or "LeftSemi" in x for x in joins if "strategy=broadcast" in x)


def test_nearest_against_brute_force(spark, monkeypatch):
    """Blocks of queries and documents meet pair by pair, and no row stands for a product of two weights."""
    monkeypatch.setattr(search, "BLOCK", 16)
    rng = random.Random(7)
    side = lambda n: {i: {f"t{t}": float(rng.randint(0, 3)) for t in rng.sample(range(12), rng.randint(1, 4))} for i in range(n)}
    queries, docs = side(40), side(60)
    expected = {}
    for q, a in queries.items():
        hits = []
        for d, b in docs.items():
            if dot := sum(w * b.get(t, 0.0) for t, w in a.items()):
                size = sum(w * w for w in a.values()) ** 0.5 * sum(w * w for w in b.values()) ** 0.5
                hits.append((-round(dot / size, 9), d))
        if hits:
            expected[q] = min(hits)[1]
    frame = lambda x: spark.createDataFrame([(i, t, w) for i, v in x.items() for t, w in v.items()], "doc long, term string, weight double")
    got = search.nearest(frame(queries), frame(docs))
    assert {r.query: r.doc for r in got.collect()} == expected
    assert "FlatMapCoGroupsInPandas" in got._jdf.queryExecution().executedPlan().toString()

"""Recall and what the named methods decide, on the whole small tables and on planted cases."""

import random

import pytest
from pyspark.sql import functions as F

from quillmark.llm import increment, mojibake, names, queries, truncation
from quillmark.runtime import table

DATA = "/root/testdata/sf0.001"


def test_planted_cuts_are_found(spark):
    """Whole texts of a field cut at random places inside words: nine of ten at least come out, and no whole one."""
    rng = random.Random(3)
    source = table(spark, DATA, "rd_resource_candidate").filter("description is not null").select("id", "description")
    found = {r.id for r in truncation.find_cut(truncation.values(source.withColumn("s", F.lit("x")), "f", "id", "description", "s")).collect()}
    whole = sorted((r.id, r.description) for r in source.collect() if r.id not in found)
    planted, rows = set(), []
    for k in range(20):
        for i, t in whole:
            rows.append((100_000 * (k + 1) + i, t))
    for i, t in whole:
        at = rng.randint(len(t) // 3, 2 * len(t) // 3)
        while not (t[at - 1].isalpha() and t[at].isalpha()):
            at -= 1
        planted.add(i)
        rows.append((i, t[:at]))
    df = spark.createDataFrame(rows, "id long, description string").withColumn("s", F.lit("x"))
    got = {r.id for r in truncation.find_cut(truncation.values(df, "f", "id", "description", "s")).collect()}
    assert len(got & planted) >= 0.9 * len(planted) and not got - planted


def test_fit_of_ends():
    cells = [("opened", 255, 0.99, 480.0), ("opened", 0, 0.0, 285.0), ("ended", 0, 0.0, 27_000.0), ("ended", 255, 0.99, 20.0), ("seen end", 0, 0.0, 2_000.0)]
    says, base, at = truncation.fit_ends(cells)
    assert says["opened"] > 100 and says["ended"] < 0.1 and 0.005 < base < 0.02 and at[255] > 0.9
    flat = truncation.fit_ends([("ended", 40, 0.9, 200.0), ("ended", 0, 0.0, 400.0)])[2]
    assert flat[40] < 0.1  # whole texts of one length are no limit


def test_the_posterior_chooses_between_chains(spark):
    """A record whose chains are as likely by themselves is read as its source is."""
    clean = "un café à côté"
    data = [(i, "s", clean) for i in range(500)] + [(1000 + i, "t", f"{clean} {i}".encode().decode("cp1252")) for i in range(20)]
    got = {r.id: (r.chain, r.restored) for r in mojibake.repair(spark.createDataFrame(data, "id long, s string, t string"), "id", "t", "s").collect()}
    assert {i: t for i, (_, t) in got.items()} == {1000 + i: f"{clean} {i}" for i in range(20)}
    rivals = mojibake.diagnose(data[-1][2], mojibake.Model({}))
    assert len(rivals) >= 1


def test_counts_of_a_large_corpus_turn_no_dash():
    """Dashes between digits are no unseen characters, however often others are seen; nor do they add a layer to a repair."""
    counts = mojibake.Counter()
    for t in ("5–9 µm", "привет по пути"):
        mojibake.pairs_of(t, counts)
    model = mojibake.Model({p: 1_000_000 * n for p, n in counts.items()})
    assert mojibake.diagnose("of 5–9 mm", model) == []
    assert mojibake.likeliest(mojibake.diagnose("of 5–9 mm".encode().decode("cp1252"), model)) == "of 5–9 mm"


@pytest.mark.parametrize("depth", [1, 3, 6])
def test_layers_of_any_number(spark, depth):
    text = "façade – 5 µm naïve"
    broken = text
    for _ in range(depth):
        broken = broken.encode().decode("latin-1")
    df = spark.createDataFrame([(i, "s", text) for i in range(3000)] + [(9000, None, broken)], "id long, s string, t string")
    assert {r.id: r.restored for r in mojibake.repair(df, "id", "t", "s").collect()} == {9000: text}


def test_planted_spellings_are_linked(spark):
    given = table(spark, DATA, "given_name_ref")
    first = sorted({r.given_name for r in given.collect()})
    rng = random.Random(8)
    entity, rows = {}, []
    for k in range(40):
        last, g = "".join(rng.choice("bdfgklmnprstvz") + rng.choice("aeiou") for _ in range(4)).capitalize(), first[k % len(first)]
        slip = last[:3] + last[4] + last[3] + last[5:]
        for name in (f"{last}, {g}", f"{g} {last}", f"{last}, {g[0]}.", f"{slip}, {g}", f"{last.upper()}, {g.upper()}"):
            entity[name] = k
            rows.append((name,))
    got = {r.name: r.entity for r in names.persons(spark.createDataFrame(rows, "name string"), given).collect()}
    pairs = [(a, b) for a in entity for b in entity if a < b and entity[a] == entity[b]]
    linked = [(a, b) for a, b in pairs if got[a] is not None and got[a] == got[b]]
    assert len(linked) >= 0.95 * len(pairs)
    assert not [(a, b) for a in entity for b in entity if a < b and entity[a] != entity[b] and got[a] is not None and got[a] == got[b]]


def test_repeats_of_the_table_against_brute_force(spark):
    rows = queries._submissions(spark, DATA)
    data = [(r.id, r.batch, r.addr, r.host, r.words) for r in rows.collect()]
    accepted, expected = [], []
    for batch in sorted({r[1] for r in data if r[1]}):
        new = []
        for r in (r for r in data if r[1] == batch):
            hit = []
            for a in accepted:
                near = bool(r[3]) and r[3] == a[3] and r[4] and a[4]
                x, y = set(r[4] or []), set(a[4] or [])
                if (r[2] and r[2] == a[2]) or (near and len(x & y) >= 0.8 * len(x | y) - 1e-9):
                    hit.append((a[1], a[0]))
            (expected.append((r[0], min(hit)[1])) if hit else new.append(r))
        accepted += new
    got = sorted(map(tuple, increment.deduplicate_history(rows).collect()))
    assert got == sorted(expected)

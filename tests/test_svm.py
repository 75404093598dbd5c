"""Splits fitted side by side against MLlib, and the jobs that ten splits take."""

import random

from pyspark.sql import functions as F

from quillmark.operators import models, svm
from quillmark.plans import QUERIES

DATA = "/root/testdata/sf0.001"


def _texts(spark):
    rng, rows = random.Random(5), []
    for i in range(300):
        good = rng.random() < 0.4
        words = [rng.choice(["moved", "site", "new", "gone"] if good and rng.random() < 0.4 else ["cell", "mouse", "line", "site", "data"]) for _ in range(rng.randrange(12))]
        rows.append((i, " ".join(words), "good" if good else "bad"))
    return spark.createDataFrame([*rows, (900, "", "bad"), (901, "  Alone\n", "good"), (902, "no label here", ""), (903, "no label", None), (904, None, "good")], "id long, t string, class string")


def test_splits_side_by_side_equal_fits_one_by_one(spark, monkeypatch):
    df, seeds = _texts(spark).coalesce(2).cache(), [3, 4]
    expected = []
    for seed in seeds:
        train, test = models.split_by_key(models.labelled(df, "t", "class"), "id", seed)
        out = models.classify(models.train_classifier(train, "t", "class"), test)
        q = models.quality(out.withColumn("label", (F.col("class") == "good").cast("double"))).first()
        expected.append((q.tp, q.fp, q.fn))
    assert svm.held_out(df, "id", "t", "class", seeds) == expected
    monkeypatch.setattr(svm, "SENT", 1)  # one split at a time
    monkeypatch.setattr(svm, "ROUNDS", 3)
    few = svm.held_out(df, "id", "t", "class", seeds)
    monkeypatch.setattr(svm, "DIRECT", 1)  # results added up among tasks
    monkeypatch.setattr(svm, "SENT", 1 << 26)
    assert svm.held_out(df, "id", "t", "class", seeds) == few


def test_small_blocks_hold_every_text(spark, monkeypatch):
    df = _texts(spark)
    monkeypatch.setattr(svm, "BLOCK_WORDS", 7)
    monkeypatch.setattr(svm, "BLOCK_TEXTS", 3)
    bags = svm._bags(df, "id", "t", "class", [1, 2], "good")
    names = spark.sparkContext.broadcast(svm.vocabulary(bags, 2).column("pair").combine_chunks())
    batches = bags.coalesce(1).toArrow().to_batches()
    rows = [r for b in svm._encode(2, names)(iter(batches)) for r in b.to_pylist()]
    assert len(rows) > 100 and sum(len(r["good"]) for r in rows) == 302 and max(len(r["good"]) for r in rows) <= 3
    assert sum(r["moments"][0] for r in rows) == models.split_by_key(models.labelled(df, "t", "class"), "id", 1)[0].count()


def test_vocabulary_keeps_the_most_frequent_pairs_of_each_split(spark):
    rows = [("a b a b", 1), ("a b c", 1), ("b c d", 3), ("c d", 2), ("c d", 2), ("x y", 2), ("q r", 1)]
    bags = spark.createDataFrame(rows, "t string, train long").select(F.split("t", " ").alias("words"), F.lit(True).alias("good"), "train")
    got = lambda most: {r["pair"]: (r["member"], r["d0"], r["d1"]) for r in svm.vocabulary(bags, 2, most).to_pylist()}
    assert got(10) == {"a b": (1, 2, 0), "b c": (1, 2, 1), "c d": (2, 1, 3)}
    assert got(1) == {"a b": (1, 2, 0), "c d": (2, 1, 3)}


def test_nothing_to_learn_from(spark, monkeypatch):
    monkeypatch.setattr(svm, "ROUNDS", 2)
    df = _texts(spark).coalesce(2)
    assert svm.held_out(df.filter("id < 0"), "id", "t", "class", [1, 2]) == [(0, 0, 0)] * 2
    one = svm.held_out(df.filter("id = 901"), "id", "t", "class", [1, 2, 3, 4])
    assert set(one) <= {(0, 0, 0), (0, 0, 1)}
    assert all(tp == 0 and fn == 0 for tp, fp, fn in svm.held_out(df.filter("class = 'bad'"), "id", "t", "class", [1]))


def test_ten_splits_share_their_jobs(spark, monkeypatch):
    monkeypatch.setattr(svm, "ROUNDS", 2)
    spark.sparkContext.setJobGroup("ml01", "")
    try:
        assert QUERIES["ml01_classifier"](spark, DATA).count() == 11
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("ml01")) < 80

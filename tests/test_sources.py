"""Readers, acronyms, models and streams on literal fixtures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quillmark import cli
from quillmark.functions import url
from quillmark.operators import acronyms, models
from quillmark.plans import QUERIES
from quillmark.runtime import table
from quillmark.sources import articles, lines, pages, publishers
from quillmark.streaming import validation

DATA = "/root/testdata/sf0.001"
ARTICLE = """<?xml version="1.0"?><article xmlns:xlink="http://www.w3.org/1999/xlink"><front><journal-meta><journal-title>J Test</journal-title></journal-meta><article-meta>
<article-id pub-id-type="pmid">12</article-id><article-id pub-id-type="pmc">34</article-id><title-group><article-title>On <i>cells</i></article-title></title-group>
<author-notes><p>Write to http://no.example</p></author-notes></article-meta></front><body><sec><title>Introduction</title><p>See <ext-link xlink:href="http://a.example/x">here</ext-link> first</p></sec>
<sec><title>Materials and Methods</title><p>We used ImageJ<xref>1</xref>.</p><sec><title>Cells</title><p>Grown</p></sec></sec><sec><title>Results</title><table><tr><td>Cell <ext-link xlink:href="http://b.example"/></td></tr></table></sec></body></article>"""


def test_article():
    a = articles.parse(ARTICLE.encode())
    assert (a["pubmed_id"], a["pmc_id"], a["title"], a["journal_title"]) == ("12", "34", "On cells", "J Test")
    assert a["section_titles"] == ["Introduction", "Materials and Methods", "Cells", "Results"]
    assert a["methods"] == "We used ImageJ.\nGrown."
    assert a["links"] == [{"url": "http://a.example/x", "context": "See here first"}, {"url": "http://b.example", "context": "Cell"}]
    assert articles.parse(None)["paragraphs"] == [] and articles.parse(b"<article><p>cut")["title"] is None


def test_read_articles(spark, tmp_path):
    (tmp_path / "J").mkdir()
    for name in ("J_2012_May_3.nxml", "J_2013_May_3.nxml", "J%20_2012.nxml"):
        (tmp_path / "J" / name).write_text(ARTICLE)
    got = articles.read_articles(spark, str(tmp_path), year=2012)
    assert got.count() == 1
    assert sorted(r.url for r in articles.link_mentions(got).collect()) == ["http://a.example/x", "http://b.example"]
    done = got.select("path")
    assert articles.read_articles(spark, str(tmp_path), year=2012, done=done).count() == 0


TYPED = """<article xmlns:xlink="http://www.w3.org/1999/xlink"><front><article-id pub-id-type="pmid">7</article-id></front><body><p>Get it at http://typed.example/a/. Or (http://typed.example/b) or http://typed.example/i.jpg or www.bare.org here</p>
<p>Again http://typed.example/b and <ext-link xlink:href="http://typed.example/b/">it</ext-link> <ext-link xlink:href="http://dx.doi.org/1">doi</ext-link></p><title><ext-link xlink:href="http://between.example/"/></title>
<p>Linked <ext-link xlink:href="http://typed.example/c">http://typed.example/c</ext-link>, too. Ends with http://end.example/x</p></body><back><ext-link xlink:href="http://late.example/"/></back></article>"""


def test_url_mentions_of_text_and_links(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.nxml").write_text(TYPED)
    cli.main(["extract-urls", "--articles", str(tmp_path / "in"), "--out", str(tmp_path / "out")])
    got = {r.url: r.context[:5] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {"http://typed.example/a": "Get i", "http://typed.example/b": "Get i", "http://typed.example/c": "Linke", "http://end.example/x": "Linke", "http://between.example": "http:", "http://late.example": "http:"}
    text = spark.createDataFrame([("See www.bare.org and http://a.example/x",)], "t string")
    assert text.select(url.text_addresses(F.col("t"))).first()[0] == ["http://a.example/x", "www.bare.org"]


def test_links_of_a_broken_article():
    assert articles.parse(b'<article xmlns:xlink="x"><p>cut <ext-link xlink:href="http://a.example"/>')["links"] == [{"url": "http://a.example", "context": "http://a.example"}]


def test_page():
    p = pages.parse('<title>T</title><script>x</script><meta http-equiv="refresh" content="0; url=http://n.example/"><p>It is a database of cells<li>one<td>cell</td><a href="/about.html">About us</a><frame src="f.html">')
    assert p["title"] == "T" and p["about"] == "/about.html" and p["refresh"] == "http://n.example/" and p["frames"] == ["f.html"]
    assert [(s["kind"], s["content"]) for s in p["sections"][:3]] == [("paragraph", "It is a database of cells"), ("item", "one"), ("cell", "cell")]
    assert p["description"] == "It is a database of cells"
    assert pages.parse(None)["sections"] == [] and pages.parse("<p><<<b")["title"] is None


def test_publisher_hits(spark):
    body = "<r><total>2</total><record><title>A</title><creator>Smith, J</creator><doi>doi:10.1/x</doi></record><record><title>B</title><creator>ImageJ team</creator></record></r>"
    df = spark.createDataFrame([("p", "ImageJ", body), ("p", "x", None), ("p", "x", "<broken")], "publisher string, term string, body string")
    got = publishers.usable(publishers.read_hits(df)).collect()
    assert [(r.title, r.doi, r.total) for r in got] == [("A", "10.1/x", 2)]


def test_lines(spark, tmp_path):
    (tmp_path / "c.txt").write_text("a.example.org (2)\nRegistry: r1\nhttp://a.example.org/x\nsim: 0.5\nb.example.org (1)\nhttp://b.example.org/\nsim: 0.25\n")
    got = lines.host_clusters(lines.lines(spark, str(tmp_path / "c.txt"))).collect()
    assert [(r.host, r.url, r.similarity) for r in got] == [("a.example.org", "http://a.example.org/x", 0.5), ("b.example.org", "http://b.example.org/", 0.25)]
    (tmp_path / "l.txt").write_text("x nifId:n-1 ... :: 5\nx nifId:n-1 ... :: 4\n7:seven\n1.5 2\n")
    t = lines.lines(spark, str(tmp_path / "l.txt"))
    assert [(r.nif_id, r.id) for r in lines.first_ids(t).collect()] == [("n-1", 5)]
    assert [r.row for r in lines.matrix(t.filter("n = 3")).collect()] == [[1.5, 2.0]]
    assert [(r.id, r.value) for r in lines.lookup_table(t.filter("n = 2")).collect()] == [(7, "seven")]


def test_labelled_and_cached_pages(spark, tmp_path):
    (tmp_path / "d.xml").write_text('<data-set><data nif-id="n1" url="u" type="t" label="good">text</data><data nif-id="n2" url="v" type="t" label="bad">more</data></data-set>')
    assert sorted((r.nif_id, r.label, r.content) for r in lines.labelled_documents(spark, str(tmp_path / "d.xml")).collect()) == [("n1", "good", "text"), ("n2", "bad", "more")]
    (tmp_path / "p.xml").write_text('<docs><doc url="u" redirect-url="w"><title>T</title><content>c</content></doc></docs>')
    assert [tuple(r) for r in lines.cached_pages(spark, str(tmp_path / "p.xml")).collect()] == [("u", "w", "T", None, "c")]


def test_a_batch_written_again_replaces_itself(spark, tmp_path):
    df = spark.createDataFrame([(1, "201301"), (2, "201302")], "id int, batch_id string")
    for _ in range(2):
        lines.overwrite_batches(df, str(tmp_path / "t"))
    lines.overwrite_batches(df.filter("id = 2").withColumn("id", F.lit(3)), str(tmp_path / "t"))
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [1, 3]


@pytest.mark.parametrize(
    ("acronym", "before", "expected"),
    [("MRI", "we used magnetic resonance imaging ", "magnetic resonance imaging"), ("SEM", "the standard error of the mean ", None), ("NIH", "at the National Institutes of Health ", "National Institutes of Health"), ("PCRs", "polymerase chain reactions ", "polymerase chain reactions"), ("XYZ", "nothing here ", None)],
)
def test_expansion(acronym, before, expected):
    assert acronyms.expansion(acronym, before) == expected


def test_weighted_distance():
    assert acronyms.weighted_distance("t-cell", "t cell") == 0.5 and acronyms.weighted_distance("tcell", "t cell") == 1.0 and acronyms.weighted_distance("", "ab") == 2.0
    assert acronyms.token_distance("a b c".split(), "a c".split()) == 1


def test_acronym_clusters(spark):
    rows = [("MRI", "magnetic resonance imaging")] * 3 + [("MRI", "Magnetic Resonance Imaging"), ("MRI", "magnetic-resonance imaging"), ("MRI", "mouse reference index")]
    got = {r.expansion: r.cluster_id for r in acronyms.cluster_variants(spark.createDataFrame(rows, "acronym string, expansion string")).collect()}
    assert got == {"magnetic resonance imaging": 1, "Magnetic Resonance Imaging": 1, "magnetic-resonance imaging": 1, "mouse reference index": 2}
    docs = spark.createDataFrame([(1, "We used magnetic resonance imaging (MRI). Then (MRI) again."), (2, None)], "id long, t string")
    assert [(r.acronym, r.expansion) for r in acronyms.mine(docs, "id", "t").collect()] == [("MRI", "magnetic resonance imaging")]


def test_classifier_on_held_out_rows(spark):
    rows = [(i, ("this site has moved to a new address " if i % 2 else "this database holds cell lines of mice ") + f"word{i % 7}", "good" if i % 2 else "bad") for i in range(200)]
    df = spark.createDataFrame([*rows, (999, "unlabelled", None), (1000, None, "good")], "id long, t string, class string")
    train, test = models.split_by_key(df.filter("t is not null and class is not null"), "id", 3)
    out = models.classify(models.train_classifier(train, "t", "class"), test).withColumn("label", (F.col("class") == "good").cast("double"))
    assert models.quality(out).first().f1 > 0.95


def test_topics_read_every_text(spark):
    common = [(i, "alpha beta gamma" if i % 2 else "delta epsilon zeta") for i in range(60)]
    rare = [(100 + i, f"rarest{'abcdefghij'[i // 2]} lonely{'abcdefghij'[i // 2]}") for i in range(20)]
    df = spark.createDataFrame([*common, *rare, (900, None), (901, "")], "id long, t string")
    model = models.train_topics(df, "t", topics=4, rounds=3)
    # Without a text's words in the fit, their weight would be the same in all topics.
    weights = {}
    for r in models.topic_words(model, 26).collect():
        weights.setdefault(r.word, []).append(r.weight)
    assert len(weights) == 26 and all(max(w) > 1.5 * min(w) for w in weights.values())
    first = [tuple(r) for r in models.topic_words(model, 5).collect()]
    assert len(first) == 20
    words = {}
    for r in models.document_words(model, df, "id", "t").collect():
        words.setdefault(r.id, []).append(r.word)
    assert sorted(words[0]) == ["delta", "epsilon", "zeta"] and sorted(words[101]) == ["lonelya", "raresta"] and not {900, 901} & set(words)


def test_topic_words_without_the_matrix_in_the_driver(spark, monkeypatch):
    """Every share is above 0, so the words are those found by working the shares out, which takes the whole matrix to the driver."""
    df = spark.createDataFrame([(i, "alpha beta gamma" if i % 2 else "delta epsilon zeta eta") for i in range(40)] + [(90, ""), (91, "the of")], "id long, t string")
    model = models.train_topics(df, "t", topics=3, rounds=2)
    heavy = models.topic_words(model, 2).groupBy("word").agg(F.collect_set("topic").alias("of"))
    x = models.topics_of(model, df, "t").select("id", "topics", F.explode(F.array_distinct(F.split("t", " "))).alias("word")).join(heavy, "word")
    expected = {(r.id, r.word) for r in x.collect() if any(r.topics[t] > 0 for t in r.of)}
    monkeypatch.setattr(models, "topics_of", None)
    assert {tuple(r) for r in models.document_words(model, df, "id", "t", 2).collect()} == expected


def test_topics_are_registered_in_full(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(models, "train_topics", lambda df, content, topics=100, rounds=20, seed=1: seen.append((df.count(), topics, rounds)))
    monkeypatch.setattr(models, "topic_words", lambda model, most: None)
    QUERIES["ml02_topics"](spark, "/root/testdata/sf0.001")
    assert seen == [(table(spark, "/root/testdata/sf0.001", "registry").filter("description is not null").count(), 100, 20)]


def test_stream_of_checks(spark, tmp_path):
    t0 = dt.datetime(2014, 1, 1)
    rows = [(1, k, t0 + dt.timedelta(hours=k), k == 0) for k in range(5)] + [(2, 10 + k, t0 + dt.timedelta(hours=k), k == 4) for k in range(5)]
    schema = "site long, id long, ts timestamp, up boolean"
    for n in range(2):
        spark.createDataFrame(rows[n::2], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
    stream = validation.down_sites(validation.read_log(spark, str(tmp_path / "log"), schema))
    q = stream.writeStream.outputMode("update").format("memory").queryName("down_sites").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {r.site: (r.run, r.down) for r in spark.sql("select * from down_sites").collect()}
    assert got == {1: (4, True), 2: (0, False)}


def test_jobs_take_a_batch_and_leave_no_intermediate_tables(spark, tmp_path):
    from quillmark import cli
    from quillmark.plans import QUERIES

    assert all(q in QUERIES for q, _ in cli.JOBS.values())
    for batch in ("201511", "201512"):
        cli.main(["find-candidates", "--data", DATA, "--out", f"{tmp_path}/{batch}", "-d", batch])
        n = spark.read.parquet(f"{tmp_path}/{batch}").agg(F.sum("mentions")).first()[0]
        assert 0 < n <= spark.read.parquet(f"{DATA}/rd_urls.parquet").filter(F.col("batch_id") == batch).count()
    with pytest.raises(SystemExit):
        cli.main(["topics", "--data", DATA, "--out", "x", "-d", "201512"])


def test_second_database(spark):
    address = "jdbc:derby:memory:quillmark;create=true"
    rows = spark.createDataFrame([(1, "a"), (2, None)], "id long, name string")
    try:
        rows.write.format("jdbc").options(url=address, dbtable="source").save()
    except Exception as e:  # no driver in this build
        pytest.skip(str(e)[:80])
    got = lines.read_database(spark, address, "source")
    assert sorted(map(tuple, got.collect())) == [(1, "a"), (2, None)]

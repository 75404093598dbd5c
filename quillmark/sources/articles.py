"""Article XML (JATS) as article data, sections, paragraphs and links with their context."""

from __future__ import annotations

import io
import xml.sax
from collections.abc import Iterator
from xml.sax.handler import ContentHandler, feature_external_ges, feature_external_pes

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.functions import url

SCHEMA = (
    "pubmed_id string, pmc_id string, doi string, title string, journal_title string, paragraphs array<string>, section_titles array<string>, methods string, "
    "links array<struct<url:string,context:string>>"
)
#: Parts of an article that aren't its text.
_LEFT_OUT = {"author-notes", "permissions", "ref-list", "xref"}
#: Elements whose end also ends an address that they hold.
_ADDRESS = {"ext-link", "uri"}


class _Article(ContentHandler):
    def __init__(self):
        self.ids, self.title, self.journal, self.paragraphs, self.sections, self.methods, self.links = {}, "", "", [], [], [], []
        self._stack, self._out, self._id, self._p, self._waiting, self._cell = [], 0, None, None, [], None
        self._title: list[str] | None = None
        self._eligible = 0
        self._from = 0

    def _parts(self) -> list[str]:
        return self._p if self._p is not None else self._cell if self._cell is not None else []

    def startElement(self, name, attrs):
        self._stack.append(name)
        if name in _ADDRESS:
            self._from = len(self._parts())
        if name in _LEFT_OUT:
            self._out += 1
        if name == "article-id":
            self._id = [attrs.get("pub-id-type", ""), ""]
        elif name in ("article-title", "journal-title", "title"):
            self._title = []
        elif name == "p" and self._p is None:
            self._end_links()
            self._p = []
        elif name in ("td", "th"):
            self._cell = []
        elif name == "sec" and self._eligible:
            self._eligible += 1
        elif name == "ext-link" and not self._out:
            self._waiting.append(attrs.get("xlink:href", ""))

    def characters(self, data):
        if self._id is not None:
            self._id[1] += data
        if self._title is not None:
            self._title.append(data)
        if self._out:
            return
        if self._p is not None:
            self._p.append(data)
        elif self._cell is not None:
            self._cell.append(data)

    def endElement(self, name):
        self._stack.pop()
        if name in _LEFT_OUT:
            self._out -= 1
        if name in _ADDRESS and "http" in "".join(self._parts()[self._from :]):
            self._parts().append(" ")
        if name == "article-id" and self._id is not None:
            self.ids.setdefault(self._id[0], self._id[1].strip())
            self._id = None
        elif name in ("article-title", "journal-title", "title") and self._title is not None:
            text = " ".join("".join(self._title).split())
            self._title = None
            if name == "journal-title":
                self.journal = self.journal or text
            elif name == "article-title" and "title-group" in self._stack and "ref-list" not in self._stack:
                self.title = self.title or text
            elif name == "title" and self._stack and self._stack[-1] == "sec":
                self.sections.append(text)
                low = text.lower().strip()
                if not self._eligible and (low == "techniques" or any(w in low for w in ("method", "procedure", "experiment"))):
                    self._eligible = 1  # until the outermost eligible section closes
        elif name == "sec" and self._eligible:
            self._eligible -= 1
        elif name == "p" and self._p is not None and "p" not in self._stack:
            self._end_text(self._p)
            self._p = None
        elif name in ("td", "th") and self._cell is not None:
            self._end_text(self._cell)
            self._cell = None

    def _end_links(self, text=""):
        self.links += [{"url": u, "context": text or u} for u in self._waiting if u]
        self._waiting = []

    def endDocument(self):
        self._end_links()

    def _end_text(self, parts):
        text = " ".join("".join(parts).split())
        self._end_links(text)
        if text:
            text = text if text[-1] in ".?!:;" else text + "."
            self.paragraphs.append(text)
            if self._eligible:
                self.methods.append(text)


def parse(content: bytes | None) -> dict:
    """Parts of one article; what was read so far where the XML is broken. External entities and DTDs aren't loaded."""
    a = _Article()
    parser = xml.sax.make_parser()
    parser.setFeature(feature_external_ges, False)
    parser.setFeature(feature_external_pes, False)
    parser.setContentHandler(a)
    try:
        parser.parse(io.BytesIO(content or b""))
    except xml.sax.SAXException:
        a.endDocument()
    return {
        "pubmed_id": a.ids.get("pmid"), "pmc_id": a.ids.get("pmc"), "doi": a.ids.get("doi"), "title": a.title or None, "journal_title": a.journal or None, "paragraphs": a.paragraphs,
        "section_titles": a.sections, "methods": "\n".join(a.methods) or None, "links": a.links,
    }


def _parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = pd.DataFrame([parse(x) for x in pdf["content"]])
        if len(out):
            out.insert(0, "path", pdf["path"].to_numpy())
            yield out


def read_articles(spark: SparkSession, folder: str, year: int | None = None, done: DataFrame | None = None) -> DataFrame:
    """(path, article data) of all .nxml files under a folder; only those of a year, and not those of done(path), are opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.nxml").load(folder).select("path", "content")
    files = files.filter(~F.col("path").contains("%20"))
    if year is not None:
        files = files.filter(F.col("path").contains(f"_{year}"))
    if done is not None:
        files = files.join(done.select("path"), "path", "left_anti")
    return files.mapInPandas(_parsed, "path string, " + SCHEMA)


def link_mentions(articles: DataFrame) -> DataFrame:
    """(pubmed_id, path, url, context) of the links, each url of an article once, with its first context."""
    x = articles.select("pubmed_id", "path", F.posexplode("links").alias("pos", "link"))
    g = x.groupBy("pubmed_id", "path", F.col("link.url").alias("url")).agg(F.min_by("link.context", "pos").alias("context"))
    return g.filter("url <> ''")


def url_mentions(articles: DataFrame) -> DataFrame:
    """(pubmed_id, path, url, context) of all addresses of an article in extraction form, each once: those in the text of its paragraphs, then its links.

    The context is the first paragraph that holds the address, else that of the link. Addresses that are no resource are left
    out; bare hosts are among those, as they have no scheme.
    """
    typed = articles.select("pubmed_id", "path", F.lit(0).alias("kind"), F.posexplode("paragraphs").alias("pos", "context"))
    typed = typed.select("pubmed_id", "path", "kind", "pos", F.explode(url.text_addresses(F.col("context"))).alias("url"), "context")
    links = articles.select("pubmed_id", "path", F.lit(1).alias("kind"), F.posexplode("links").alias("pos", "link"))
    links = links.select("pubmed_id", "path", "kind", "pos", url.extraction_form(F.col("link.url")).alias("url"), "link.context")
    good = typed.unionByName(links).filter(~url.is_bad(F.col("url")))
    return good.groupBy("pubmed_id", "path", "url").agg(F.min_by("context", F.struct("kind", "pos")).alias("context"))

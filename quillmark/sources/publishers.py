"""Archived responses of publishers' search interfaces (XML) as search hits."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "publisher string, term string, total long, pubmed_id string, doi string, title string, publication_name string, publication_date string, authors array<string>, mesh_headings array<string>, description string"
#: Names that the parts of a hit have in the responses, in any namespace.
_HIT = {"message", "item", "record", "publication", "article", "result"}
_PARTS = {
    "title": "title", "publicationname": "publication_name", "publicationdate": "publication_date", "date": "publication_date", "journal": "publication_name", "journalshort": "publication_name",
    "creator": "authors", "author": "authors", "meshheading": "mesh_headings", "subject": "mesh_headings", "abstract": "description", "description": "description", "doi": "doi", "identifier": "doi", "pmid": "pubmed_id",
}
_LISTS = ("authors", "mesh_headings")


def _name(tag) -> str:
    return str(tag).rsplit("}", 1)[-1].lower()


def parse(body: str | None) -> tuple[int | None, list[dict]]:
    """(total, hits) of one response; nothing for null, empty and broken responses."""
    try:
        root = ET.fromstring(body or "")
    except ET.ParseError:
        return None, []
    total, hits = None, []
    for e in root.iter():
        n = _name(e.tag)
        if n in ("total", "totalresults", "resultcount") and total is None and (e.text or "").strip().isdigit():
            total = int(e.text.strip())
        if n in _HIT and any(_name(x.tag) in _PARTS for x in e):
            hit: dict = {k: [] for k in _LISTS}
            for x in e.iter():
                part = _PARTS.get(_name(x.tag))
                value = " ".join("".join(x.itertext()).split())
                if part and value and x is not e:
                    if part in _LISTS:
                        hit[part].append(value)
                    else:
                        hit.setdefault(part, value.removeprefix("doi:") if part == "doi" else value)
            hits.append(hit)
    return total, hits


def _rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    for pdf in batches:
        out = []
        for p, t, b in zip(pdf["publisher"], pdf["term"], pdf["body"], strict=True):
            total, hits = parse(b)
            out += [[p, t, total, *[h.get(n) for n in names[3:]]] for h in hits]
        yield pd.DataFrame(out, columns=names)


def read_hits(responses: DataFrame) -> DataFrame:
    """Hits of responses(publisher, term, body), without those whose authors hold the search term."""
    hits = responses.select("publisher", "term", "body").mapInPandas(_rows, SCHEMA)
    return hits.filter(~F.exists(F.coalesce("authors", F.array().cast("array<string>")), lambda a: F.lower(a).contains(F.lower(F.col("term")))))


def usable(hits: DataFrame, most: int = 1000) -> DataFrame:
    """Hits of terms with some, but not too many results: a term that everything matches says nothing."""
    return hits.filter((F.col("total") > 0) & (F.col("total") <= most))

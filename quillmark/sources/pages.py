"""HTML pages as typed sections, descriptions and plain text (standard-library parser in Arrow batches)."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "title string, sections array<struct<kind:string,content:string>>, description string, about string, frames array<string>, refresh string, links array<string>"
_BLOCKS = {"p", "li", "td", "th", "h1", "h2", "h3", "h4", "h5", "h6", "div", "blockquote", "dd", "dt"}
_DESCRIBES = re.compile(r"introduction|background|\bis (?:a|an)\b", re.IGNORECASE)
_REFRESH = re.compile(r"url\s*=\s*['\"]?([^'\";]+)", re.IGNORECASE)


class _Page(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.title, self.sections, self.about, self.frames, self.refresh, self.links = "", [], None, [], None, []
        self._text, self._kind, self._skip, self._in_title, self._anchor = [], "text", 0, False, None

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag in ("script", "style"):
            self._skip += 1
        elif tag == "title":
            self._in_title = True
        elif tag in _BLOCKS:
            self._flush()
            self._kind = "heading" if tag[0] == "h" and tag[1:].isdigit() else "item" if tag in ("li", "dd", "dt") else "cell" if tag in ("td", "th") else "paragraph"
        elif tag == "br":
            self._text.append(" ")
        elif tag == "a" and a.get("href"):
            self._anchor = [a["href"], ""]
            self.links.append(a["href"])
        elif tag in ("frame", "iframe") and a.get("src"):
            self.frames.append(a["src"])
        elif tag == "meta" and (a.get("http-equiv") or "").lower() == "refresh":
            m = _REFRESH.search(a.get("content") or "")
            self.refresh = m.group(1).strip() if m else None

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self._skip = max(0, self._skip - 1)
        elif tag == "title":
            self._in_title = False
        elif tag in _BLOCKS:
            self._flush()
        elif tag == "a" and self._anchor:
            if self.about is None and "about" in self._anchor[1].lower():
                self.about = self._anchor[0]
            self._anchor = None

    def handle_data(self, data):
        if self._skip:
            return
        if self._in_title:
            self.title += data
            return
        if self._anchor:
            self._anchor[1] += data
        self._text.append(data)

    def _flush(self):
        text = " ".join("".join(self._text).split())
        if text:
            self.sections.append({"kind": self._kind, "content": text})
        self._text, self._kind = [], "text"

    def close(self):
        super().close()
        self._flush()


def parse(html: str | None) -> dict:
    """Parts of one page; empty parts for null and empty input, whatever comes of broken markup."""
    page = _Page()
    page.feed(html or "")
    page.close()
    described = [s["content"] for s in page.sections if s["kind"] in ("paragraph", "text", "item") and _DESCRIBES.search(s["content"])]
    return {
        "title": " ".join(page.title.split()) or None, "sections": page.sections, "description": max(described, key=len, default=None), "about": page.about,
        "frames": page.frames, "refresh": page.refresh, "links": page.links,
    }


def _run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for s in batches:
        yield pd.DataFrame([parse(x) for x in s], columns=["title", "sections", "description", "about", "frames", "refresh", "links"])


def _annotated():
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        return _run(batches)

    return F.pandas_udf(run, SCHEMA)


def read_pages(df: DataFrame, html: str) -> DataFrame:
    """df with the parts of its pages in a column page."""
    return df.withColumn("page", _annotated()(F.coalesce(F.col(html), F.lit(""))))


def page_text(sections):
    """All sections as one text; a section without an end of a sentence gets one."""
    return F.array_join(F.transform(sections, lambda s: F.when(s["content"].rlike(r"[.?!:;]$"), s["content"]).otherwise(F.concat(s["content"], F.lit(" . ")))), "\n")


def best_description(own, about):
    """The longer of the page's own description and that of its about page."""
    return F.when(F.length(F.coalesce(about, F.lit(""))) > F.length(F.coalesce(own, F.lit(""))), about).otherwise(own)

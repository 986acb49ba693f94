"""Paragraphs of articles: JATS files and HTML pages by Arrow functions, since sections nest."""

from __future__ import annotations

import sys
import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from html.parser import HTMLParser
from pathlib import PurePosixPath

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Functions of this module travel whole, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SKIPPED = tuple(
    "acknowledgement|acknowledgment|author contribution|authors' contributions|availability of data|data availability|conflict of interest|competing interest"
    "|declaration|ethics approval|ethical approval|informed consent|funding|supplementary|references".split("|")
)
MIN_CHARS = 80
#: Files that are parsed before their paragraphs are passed on.
FILES_AT_ONCE = 64
PARAGRAPH = (
    "pmcid string, pmid string, doi string, title string, journal string, year string, source_path string, section string, paragraph_index int, text string, char_count int"
)
_CITED = re.compile(r"\s*\[[\d,\-\s]*\]")


def _tag(e: ET.Element) -> str:
    return e.tag.rpartition("}")[2] if isinstance(e.tag, str) else ""


def _fold(text: str | None) -> str:
    return " ".join((text or "").split())


def _text(e: ET.Element | None) -> str:
    return "" if e is None else _fold(" ".join(e.itertext()))


def _first(root: ET.Element, *tags: str) -> Iterator[ET.Element]:
    return (e for e in root.iter() if _tag(e) in tags)


def skipped(title: str) -> bool:
    return any(k in title.lower() for k in SKIPPED)


def _facts(root: ET.Element, path: str) -> dict[str, str]:
    def article_id(kind: str) -> str:
        return next((_fold(e.text) for e in _first(root, "article-id") if e.get("pub-id-type") == kind), "")

    years = (_fold(c.text) for e in _first(root, "pub-date") for c in e if _tag(c) == "year" and c.text)
    names = (t for t in map(_text, _first(root, "journal-title", "journal-id")) if t)
    return {
        "pmcid": article_id("pmc") or PurePosixPath(path).stem,
        "pmid": article_id("pmid"),
        "doi": article_id("doi"),
        "title": _text(next(_first(root, "article-title"), None)),
        "journal": next(names, ""),
        "year": next(years, ""),
        "source_path": path,
    }


def _paragraphs(container: ET.Element, section: list[str], least: int) -> Iterator[tuple[str, int, str]]:
    n = 0
    for child in container:
        if _tag(child) in ("p", "list", "boxed-text"):
            text = _fold(_CITED.sub("", _text(child)))
            if len(text) >= least:
                n += 1
                yield " > ".join(section) or "Body", n, text


def _walk(sec: ET.Element, above: list[str], least: int) -> Iterator[tuple[str, int, str]]:
    title = next((_text(c) for c in sec if _tag(c) == "title"), "")
    if skipped(title):
        return
    path = [*above, title] if title else above
    yield from _paragraphs(sec, path, least)
    for child in sec:
        if _tag(child) == "sec":
            yield from _walk(child, path, least)


def parse_article(content: bytes, path: str, least: int = MIN_CHARS) -> list[dict]:
    """Paragraph rows of one article file.

    Only direct paragraphs of an abstract count, so a structured abstract gives none; the first bare paragraph of the body
    gives all bare ones and ends it, sections that follow included.
    """
    root = ET.fromstring(content)
    facts, found = _facts(root, path), []
    for abstract in _first(root, "abstract"):
        found += _paragraphs(abstract, ["Abstract"], least)
    for child in next(_first(root, "body"), ()):
        if _tag(child) == "sec":
            found += _walk(child, [], least)
        elif _tag(child) == "p":
            found += _paragraphs(next(_first(root, "body")), ["Body"], least)
            break
    return [{**facts, "section": s, "paragraph_index": k, "text": t, "char_count": len(t)} for s, k, t in found]


def parse_articles(files: DataFrame, least: int = MIN_CHARS) -> DataFrame:
    """Paragraphs, and a status and error for each file, of (path, content): rows with error null are paragraphs or empty files."""

    names = [c.split()[0] for c in PARAGRAPH.split(", ")] + ["status", "error"]

    kinds = [pa.int32() if c in ("paragraph_index", "char_count") else pa.string() for c in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (batch.slice(at, FILES_AT_ONCE) for batch in batches for at in range(0, batch.num_rows, FILES_AT_ONCE)):
            rows = []
            for path, content in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                try:
                    got = parse_article(content, path, least)
                    rows += [{**r, "status": "parsed", "error": None} for r in got] or [{"source_path": path, "status": "empty", "error": None}]
                except ET.ParseError as problem:
                    rows.append({"source_path": path, "status": "failed", "error": f"{type(problem).__name__}: {problem}"})
            yield pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], kind) for c, kind in zip(names, kinds)], names)

    return files.select("path", "content").mapInArrow(run, PARAGRAPH + ", status string, error string")


def read_articles(spark: SparkSession, folder: str, pattern: str = "PMC*.xml", least: int = MIN_CHARS) -> DataFrame:
    return parse_articles(spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder), least)


def article_manifest(parsed: DataFrame) -> DataFrame:
    """One row for each file: how many paragraphs it gave, or why it failed."""
    return parsed.groupBy("source_path").agg(F.first("pmcid").alias("pmcid"), F.first("pmid").alias("pmid"), F.first("title").alias("title"), F.first("status").alias("status"), F.count("text").alias("paragraph_count"), F.first("error").alias("error"))


class _Sections(HTMLParser):
    """Paragraphs under the path of headings they stand in; scripts, styles and navigation are left out."""

    _HIDDEN, _BLOCK = {"script", "style", "nav", "footer", "template"}, {"p", "div", "li", "ul", "ol", "table", "tr", "td", "section", "article", "br", "pre", "blockquote"}

    def __init__(self, least: int):
        super().__init__(convert_charrefs=True)
        self.least, self.path, self.held, self.hidden, self.level, self.rows, self.numbers = least, [], [], 0, 0, [], {}

    def flush(self) -> None:
        text, self.held = _fold(" ".join(self.held)), []
        if self.level:
            self.path = [p for p in self.path if p[0] < self.level] + ([(self.level, text)] if text else [])
            self.level = 0
        elif len(text) >= self.least and not any(skipped(t) for _, t in self.path):
            section = " > ".join(t for _, t in self.path) or "Body"
            self.numbers[section] = self.numbers.get(section, 0) + 1
            self.rows.append((section, self.numbers[section], text))

    def handle_starttag(self, tag, attrs):
        if tag in self._HIDDEN:
            self.hidden += 1
        elif re.fullmatch("h[1-6]", tag):
            self.flush()
            self.level = int(tag[1])
        elif tag in self._BLOCK:
            self.flush()

    def handle_endtag(self, tag):
        if tag in self._HIDDEN:
            self.hidden = max(0, self.hidden - 1)
        elif re.fullmatch("h[1-6]", tag) or tag in self._BLOCK:
            self.flush()

    def handle_data(self, data):
        if not self.hidden:
            self.held.append(data)


def parse_html(html: str | None, least: int = MIN_CHARS) -> list[tuple[str, int, str]]:
    parser = _Sections(least)
    parser.feed(html or "")
    parser.close()
    parser.flush()
    return parser.rows


def html_sections(pages: DataFrame, key: str, html: str, min_chars: int = MIN_CHARS) -> DataFrame:
    """(key, section, paragraph_index, text, char_count) of HTML pages."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(k, *r, len(r[2])) for k, h in zip(batch[key], batch[html]) for r in parse_html(h, min_chars)]
            yield pd.DataFrame(rows, columns=[key, "section", "paragraph_index", "text", "char_count"])

    kind = pages.schema[key].dataType.simpleString()
    return pages.select(key, html).mapInPandas(run, f"{key} {kind}, section string, paragraph_index int, text string, char_count int")

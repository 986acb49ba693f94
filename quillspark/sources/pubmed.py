"""Literature search and article download as Python data sources; one partition for each query or group of articles.

A transport fetches a URL and gives bytes. The default goes to the network; tests give one that reads fixtures.
"""

from __future__ import annotations

import sys
import json
import time
from collections.abc import Callable, Iterator
from os import environ
from pathlib import Path
from urllib import parse, request
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from quillspark.functions.text import article_key, looks_like_article
from quillspark.operators.registry import FIELDS

#: Functions of this module travel whole, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SERVICE = "https://eutils.ncbi.nlm.nih.gov/entrez/eutils"
RECORD = ", ".join(f"{f} string" for f in FIELDS)
Transport = Callable[[str], bytes]


def over_network(url: str) -> bytes:
    with request.urlopen(url, timeout=60) as response:
        return response.read()


def from_folder(folder: str) -> Transport:
    """Answers kept as files, named by the service's endpoint and the words of the query or the identifiers."""

    def fetch(url: str) -> bytes:
        parts = parse.urlsplit(url)
        asked = dict(parse.parse_qsl(parts.query))
        name = f"{Path(parts.path).stem}-{asked.get('term') or asked.get('id')}"
        return (Path(folder) / ("".join(c if c.isalnum() else "_" for c in name) + ".xml")).read_bytes()

    return fetch


def url_of(endpoint: str, **asked: str) -> str:
    own = {k: environ[v] for k, v in (("api_key", "NCBI_API_KEY"), ("email", "NCBI_EMAIL")) if environ.get(v)}
    return f"{SERVICE}/{endpoint}?{parse.urlencode({'tool': 'quillspark', **asked, **own})}"


def search_ids(query: str, most: int, fetch: Transport) -> list[str]:
    root = ET.fromstring(fetch(url_of("esearch.fcgi", db="pubmed", term=query, retmode="xml", retmax=str(most), sort="relevance")))
    return [e.text for e in root.findall(".//IdList/Id") if e.text]


def _at(node: ET.Element, path: str) -> str:
    return " ".join((node.findtext(path) or "").split())


def _all(node: ET.Element | None) -> str:
    return "" if node is None else " ".join("".join(node.itertext()).split())


def parse_record(article: ET.Element) -> dict[str, str]:
    """A registry record; a structured abstract keeps its labels, a line each."""
    ids = {e.get("IdType"): e.text or "" for e in reversed(article.findall(".//ArticleIdList/ArticleId"))}
    said = ((e.get("Label"), _all(e)) for e in article.findall(".//Abstract/AbstractText"))
    years = (_at(article, f".//{p}/Year") for p in ("JournalIssue/PubDate", "ArticleDate", "DateCompleted"))
    pmid = _at(article, ".//MedlineCitation/PMID")
    known = {
        "pmid": pmid,
        "pmcid": ids.get("pmc", ""),
        "title": _all(article.find(".//ArticleTitle")),
        "year": next((y for y in years if y), ""),
        "journal": _at(article, ".//Journal/Title"),
        "doi": ids.get("doi", ""),
        "abstract": "\n".join(f"{k}: {t}" if k else t for k, t in said if t),
        "source_url": f"https://pubmed.ncbi.nlm.nih.gov/{pmid}/" if pmid else "",
        "has_full_text": "yes" if ids.get("pmc") else "unknown",
    }
    return {f: known.get(f, "") for f in FIELDS}


def fetch_records(ids: list[str], fetch: Transport) -> list[dict[str, str]]:
    if not ids:
        return []
    return [parse_record(a) for a in ET.fromstring(fetch(url_of("efetch.fcgi", db="pubmed", id=",".join(ids), retmode="xml"))).findall(".//PubmedArticle")]


class _Query(InputPartition):
    def __init__(self, key: str, query: str):
        super().__init__(key)
        self.key, self.query = key, query


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.queries, self.most = json.loads(options["queries"]), int(options.get("maxresults", 50))
        self.pause, self.folder = float(options.get("pause", 0.34)), options.get("folder")

    def partitions(self):
        return [_Query(k, q) for k, q in self.queries.items()]

    def read(self, part):
        fetch = from_folder(self.folder) if self.folder else over_network
        ids = search_ids(part.query, self.most, fetch)
        if not self.folder:
            time.sleep(self.pause)
        for r in fetch_records(ids, fetch):
            yield (part.key, *(r[f] for f in FIELDS))


class PubmedSource(DataSource):
    """Options: queries (JSON of key to search string), maxResults, pause, and folder for answers that are kept as files."""

    @classmethod
    def name(cls):
        return "pubmed"

    def schema(self):
        return f"query_key string, {RECORD}"

    def reader(self, schema):
        return _Reader({k.lower(): v for k, v in self.options.items()})


def search(spark: SparkSession, queries: dict[str, str], most: int = 50, folder: str | None = None) -> DataFrame:
    spark.dataSource.register(PubmedSource)
    reader = spark.read.format("pubmed").option("queries", json.dumps(queries)).option("maxResults", str(most))
    return (reader.option("folder", folder) if folder else reader).load()


MANIFEST = "pmcid string, status string, bytes bigint, error string, content binary"


def fetch_articles(registry: DataFrame, have: DataFrame | None = None, transport: Transport = over_network, pause: float = 0.34, overwrite: bool = False) -> DataFrame:
    """The registry's rows with an article number, each with status (skipped_existing, downloaded or failed), bytes, error and content.

    have: (pmcid, bytes) of files that exist. Rows to fetch are what an anti-join leaves.
    """
    rows = registry.withColumn("pmcid", article_key("pmcid")).where("pmcid <> ''")
    old = None if have is None or overwrite else have.select("pmcid", F.lit("skipped_existing").alias("status"), F.col("bytes").cast("bigint").alias("bytes"), F.lit("").alias("error"), F.lit(None).cast("binary").alias("content"))
    todo = rows.select("pmcid").distinct() if old is None else rows.select("pmcid").distinct().join(old, "pmcid", "left_anti")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key in batch["pmcid"]:
                try:
                    got = transport(url_of("efetch.fcgi", db="pmc", id=key.removeprefix("PMC"), retmode="xml"))
                    out.append((key, "downloaded", len(got), "", got))
                except Exception as problem:  # the manifest tells of it
                    out.append((key, "failed", None, f"{type(problem).__name__}: {problem}", None))
                if transport is over_network:
                    time.sleep(pause)
            yield pd.DataFrame(out, columns=["pmcid", "status", "bytes", "error", "content"]).astype({"bytes": "Int64"})

    got = todo.mapInPandas(run, MANIFEST)
    odd = (F.col("status") == "downloaded") & ~looks_like_article("content")
    got = got.select("pmcid", F.when(odd, "failed").otherwise(F.col("status")).alias("status"), F.when(~odd, F.col("bytes")).alias("bytes"), F.when(odd, "ValueError: response is no article").otherwise(F.col("error")).alias("error"), F.when(~odd, F.col("content")).alias("content"))
    return rows.join(got if old is None else got.unionByName(old), "pmcid", "left")

"""Readers: line-delimited JSON, registries as CSV, settings, index metadata."""

from __future__ import annotations

import json
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.functions.text import fold
from quillspark.operators.registry import tag_source

#: Sources of a registry from before sources had a common prefix, in their order.
LEGACY = ("core", "outcome", "ultrasound", "therapy")


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str, optional: bool = False) -> DataFrame:
    """Objects, one a line; blank lines are passed over, a malformed line fails the job. optional: a missing file is an empty table."""
    if optional and not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_csv(spark: SparkSession, path: str, folded: bool = False) -> DataFrame:
    """A table with a header, all strings, cells perhaps of several lines; a byte order mark is dropped, missing cells are empty."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", "UTF-8").csv(path)
    df = df.toDF(*(c.lstrip("﻿") for c in df.columns)).na.fill("")
    return df.select(*(fold(c).alias(c) for c in df.columns)) if folded else df


def discover_sources(folder: str) -> list[tuple[str, str]]:
    """(name, path) of a registry's sources: the prefixed files in order, else the legacy ones that exist."""
    base = Path(folder)
    found = sorted(base.glob("pubmed_*.csv"))
    if found:
        return [(p.stem.removeprefix("pubmed_"), str(p)) for p in found]
    return [(n, str(base / f"{n}.csv")) for n in LEGACY if (base / f"{n}.csv").exists()]


def read_sources(spark: SparkSession, sources: Sequence[tuple[str, str]], seq: str = "seq") -> DataFrame | None:
    """All sources' rows, tagged and in one order (source, then place in the file); None if there are none."""
    whole = None
    for rank, (name, path) in enumerate(sources):
        if not _exists(spark, path):
            continue
        part = tag_source(read_csv(spark, path), name, rank).withColumn(seq, F.struct(F.lit(rank).alias("rank"), F.monotonically_increasing_id().alias("line")))
        whole = part if whole is None else whole.unionByName(part, allowMissingColumns=True)
    return whole


def read_metadata(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Index metadata; fails unless row_index runs from 0 without a gap."""
    df = read_jsonl(spark, path, schema)
    n = df.agg(F.count("*").alias("n"), F.countDistinct("row_index").alias("d"), F.min("row_index").alias("low"), F.max("row_index").alias("high")).first()
    if n["n"] and (n["d"] != n["n"] or n["low"] != 0 or n["high"] != n["n"] - 1):
        raise ValueError("row_index must equal each row's position")
    return df


def read_embeddings(spark: SparkSession, path: str, vector: str = "embedding") -> DataFrame:
    """A Parquet table of vectors, as floats; fails unless all have one length."""
    df = spark.read.parquet(path)
    low, high = df.agg(F.min(F.size(vector)), F.max(F.size(vector))).first()
    if low != high:
        raise ValueError(f"vectors of {low} to {high} dimensions")
    return df.withColumn(vector, F.col(vector).cast("array<float>"))


def read_yaml(path: str) -> dict:
    import yaml

    return yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}


def pubmed_queries(path: str | None = None) -> dict[str, str]:
    """Search strings by key from settings; what is no search string is passed over, and the built-in ones stand in for a missing file."""
    if path is None or not Path(path).exists():
        return dict(BUILT_IN)
    found = {}
    for key, value in (read_yaml(path).get("queries") or {}).items():
        text = value.get("pubmed") if isinstance(value, dict) else None
        if isinstance(text, str) and text.strip():
            found[key] = " ".join(text.split())
    return found or dict(BUILT_IN)


def _any(*terms: str) -> str:
    return "(" + " OR ".join(f'"{t}"[Title/Abstract]' if " " in t or "-" in t else f"{t}[Title/Abstract]" for t in terms) + ")"


_CORE = ("idiopathic granulomatous mastitis", "granulomatous mastitis")
BUILT_IN = {
    "core_english": _any("non-puerperal mastitis", "nonpuerperal mastitis", "non-lactational mastitis", "nonlactational mastitis", *_CORE, "granulomatous lobular mastitis", "periductal mastitis", "plasma cell mastitis"),
    "treatment_outcome": f"({_any(*_CORE, 'non-lactational mastitis', 'non-puerperal mastitis')} AND {_any('treatment', 'therapy', 'outcome', 'response', 'remission', 'recurrence', 'relapse')})",
    "ultrasound": f"({_any(*_CORE, 'non-lactational mastitis')} AND {_any('ultrasound', 'ultrasonography', 'sonographic', 'imaging')})",
    "therapies": f"({_any(*_CORE)} AND {_any('corticosteroid', 'steroid', 'methotrexate', 'antibiotic', 'surgery', 'excision', 'drainage', 'aspiration')})",
}


def smoke_queries(spark: SparkSession, path: str) -> DataFrame:
    """(query_id, query, expected_any, top_k) from settings; an empty list or query is an error."""
    rows = read_yaml(path).get("queries")
    if not isinstance(rows, list) or not rows:
        raise ValueError(f"queries must be a list with entries: {path}")
    out = []
    for r in rows:
        if not str(r.get("query") or "").strip():
            raise ValueError(f"empty query: {r.get('id', '')}")
        out.append((str(r.get("id", "")), str(r["query"]).strip(), [str(x) for x in r.get("expected_any") or [] if str(x)], int(r.get("top_k") or 8)))
    return spark.createDataFrame(out, "query_id string, query string, expected_any array<string>, top_k int")


def read_answer(path: str) -> str:
    """An answer's text: the answer field of a JSON file, else the file."""
    raw = Path(path).read_text(encoding="utf-8")
    if not path.endswith(".json"):
        return raw
    answer = json.loads(raw).get("answer")
    if not isinstance(answer, str):
        raise ValueError(f"no answer in {path}")
    return answer


def read_prompt(path: str) -> str:
    text = Path(path).read_text(encoding="utf-8").strip()
    if not text:
        raise ValueError(f"empty prompt: {path}")
    return text


def sibling(path: str, kind: str) -> str:
    """The file beside an answer or a prompt that holds its evidence, evaluation or answer."""
    p = Path(path)
    stem = p.stem.removesuffix("_answer").removesuffix("_prompt")
    return str(p.with_name(f"{stem}_{kind}"))

"""Writers: line-delimited JSON, flat CSV, readable views, buckets as partitions, reports."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import fold
from quillspark.operators.registry import view


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One object a line; the committer makes the folder appear whole or not at all."""
    df.write.mode(mode).json(path)


def flat(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Single-line string cells; lists joined, what is missing empty."""
    out = []
    for c in columns or df.columns:
        if c not in df.columns:
            out.append(F.lit("").alias(c))
        elif df.schema[c].dataType.typeName() == "array":
            out.append(fold(F.array_join(F.col(c).cast("array<string>"), "; ")).alias(c))
        else:
            out.append(fold(F.col(c).cast("string")).alias(c))
    return df.select(*out)


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None, separator: str = ",", mode: str = "errorifexists") -> None:
    flat(df, columns).write.mode(mode).option("header", True).option("sep", separator).option("escape", '"').option("emptyValue", "").csv(path)


def write_views(df: DataFrame, path: str, columns: Sequence[str], mode: str = "errorifexists") -> None:
    """The readable extract as comma and as tab separated files."""
    v = view(df, columns)
    for name, sep in (("csv", ","), ("tsv", "\t")):
        v.write.mode(mode).option("header", True).option("sep", sep).option("escape", '"').option("emptyValue", "").csv(f"{path}/{name}")


def write_buckets(df: DataFrame, path: str, bucket: str = "bucket", mode: str = "errorifexists") -> None:
    """Parquet partitioned by bucket, which later reads of one bucket prune to."""
    df.write.mode(mode).partitionBy(bucket).parquet(path)


def write_per_query(records: DataFrame, path: str, key: str = "query_key", mode: str = "errorifexists") -> None:
    flat(records).write.mode(mode).partitionBy(key).option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def report_text(title: str, sections: dict[str, dict]) -> str:
    """A Markdown report of counts and thresholds."""
    lines = [f"# {title}", "", f"created_at: {datetime.now(timezone.utc).isoformat()}"]
    for name, values in sections.items():
        lines += ["", f"## {name}", *(f"{k}: {v}" for k, v in values.items())]
    return "\n".join(lines) + "\n"


def bucket_report(df: DataFrame, title: str, bucket: str = "bucket", extra: dict[str, dict] | None = None) -> str:
    """A report of the rows in each bucket; only the counts come to the driver."""
    counts = {r[0]: r[1] for r in df.groupBy(bucket).agg(F.count("*")).collect()}  # one row for each bucket
    return report_text(title, {"Counts": {b: counts.get(b, 0) for b in ("strict", "review", "excluded")}, **(extra or {})})


def write_text(path: str, value: str) -> None:
    p = Path(path)
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_text(value, encoding="utf-8")


def write_json(path: str, value: dict) -> None:
    p = Path(path)
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_text(json.dumps(value, ensure_ascii=False, indent=2) + "\n", encoding="utf-8")


def write_row(df: DataFrame, path: str) -> None:
    """A one-row report as JSON, with the time it was made."""
    row = df.first()
    write_json(path, {"created_at": datetime.now(timezone.utc).isoformat(), **(row.asDict(recursive=True) if row else {})})


def write_rag_package(folder: str, question: str, found: list[dict], prompt: str, name: str) -> dict[str, str]:
    """One question's evidence and prompt as a pair of files; their paths."""
    paths = {"evidence_path": f"{folder}/{name}_evidence.json", "prompt_path": f"{folder}/{name}_prompt.txt"}
    write_json(paths["evidence_path"], {"created_at": datetime.now(timezone.utc).isoformat(), "question": question, "evidence_count": len(found), "evidence": found})
    write_text(paths["prompt_path"], prompt)
    return paths


def write_answer(path: str, answer: str, prompt_path: str, settings: dict) -> dict[str, str]:
    """One answer for reading and with its settings; path is without an ending."""
    paths = {"answer_md": f"{path}.md", "answer_json": f"{path}.json"}
    write_json(paths["answer_json"], {"created_at": datetime.now(timezone.utc).isoformat(), "prompt_path": prompt_path, "model_path": settings.get("model_path", ""), "generation": settings.get("generation", {}), "answer": answer})
    write_text(paths["answer_md"], answer.strip() + "\n")
    return paths


def embedding_manifest(vectors: DataFrame, model_path: str, source: str, vector: str = "embedding") -> dict:
    """What an embedding table's manifest says: counts, dimensions, type and where it came from."""
    r = vectors.agg(F.count("*").alias("n"), F.max(F.size(vector)).alias("d")).first()
    return {"created_at": datetime.now(timezone.utc).isoformat(), "source": source, "model_path": model_path, "chunk_count": r["n"], "embedding_dim": r["d"] or 0, "dtype": "float32", "normalized": True}


def index_manifest(vectors: DataFrame, path: str, vector: str = "embedding") -> dict:
    """As :func:`embedding_manifest` for an index of inner products."""
    r = vectors.agg(F.count("*").alias("n"), F.max(F.size(vector)).alias("d")).first()
    return {"created_at": datetime.now(timezone.utc).isoformat(), "index_path": path, "index_type": "exact inner product", "metric": "cosine of unit vectors", "chunk_count": r["n"], "embedding_dim": r["d"] or 0}


def merge_report(summary: dict[str, int]) -> str:
    """The report of a merged registry: totals, and records of each source."""
    own = {k: v for k, v in summary.items() if not k.startswith("source:")}
    return report_text("Literature registry", {"Totals": own, "Records by source": {k.removeprefix("source:"): v for k, v in sorted(summary.items()) if k.startswith("source:")}})


def semantic_report(df: DataFrame, thresholds, anchors: dict[str, int], final: str = "semantic_final_status") -> str:
    """The second pass's report: counts by final status and by decision, anchors, thresholds."""
    by = {c: {r[0]: r[1] for r in df.groupBy(c).agg(F.count("*")).collect()} for c in (final, "semantic_decision")}  # a few rows each
    return report_text("Second pass", {"Final status": {b: by[final].get(b, 0) for b in ("strict", "review", "excluded")}, "Decisions": dict(sorted(by["semantic_decision"].items())), "Anchors": anchors, "Thresholds": vars(thresholds)})


def parse_report(documents: DataFrame) -> str:
    """The report of parsed documents (document_id, title, status, page counts): totals, and the failed ones by name."""
    r = documents.agg(F.count("*").alias("documents"), F.count_if(F.startswith("status", F.lit("failed"))).alias("failed"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("page_count", "native_pages", "ocr_pages", "low_text_pages"))).first()
    failed = {x["document_id"]: x["title"] for x in documents.where(F.startswith("status", F.lit("failed"))).select("document_id", "title").toLocalIterator()}
    return report_text("Parsed documents", {"Totals": r.asDict(), "Failed": failed})

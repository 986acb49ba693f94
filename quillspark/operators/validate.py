"""Checks of corpora and indexes, as issue rows and one-row reports."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.functions.text import given, is_falsy, strip
from quillspark.functions.vectors import is_finite, norm, unit
from quillspark.operators.registry import embedding_text

REQUIRED = tuple("chunk_id language source_path source_type text title".split())
REQUIRED_CJK = tuple("document_id extraction_methods page_end page_start source_pages".split())
_ISSUES = "array<struct<severity:string,issue:string,detail:string>>"


def _issue(when: Column, severity: str, issue: str, detail: Column) -> Column:
    return F.when(when, F.struct(F.lit(severity).alias("severity"), F.lit(issue).alias("issue"), detail.cast("string").alias("detail")))


def _missing(df: DataFrame, fields: Sequence[str]) -> list[Column]:
    out = []
    for f in fields:
        absent = is_falsy(f, df.schema[f].dataType.simpleString()) if f in df.columns else F.lit(True)
        out.append(F.when(absent, F.lit(f)))
    return out


def corpus_issues(chunks: DataFrame, row: str = "row_index", language: str | None = None, least: int = 40, most: int = 6000) -> DataFrame:
    """(row_index, chunk_id, severity, issue, detail) of chunks that are to be embedded. A chunk without an id is checked for missing fields only.

    Zero counts as missing, a first page numbered 0 included. Details that are lists are JSON.
    """
    cid, lang, text = strip("chunk_id"), strip("language"), strip("text")
    absent = F.array_sort(F.array_distinct(F.filter(F.concat(F.array(*_missing(chunks, REQUIRED)), F.when(lang == "zh", F.array(*_missing(chunks, REQUIRED_CJK))).otherwise(F.array().cast("array<string>"))), lambda x: x.isNotNull())))
    # Rows without an id would meet in one task: they are told apart by their place.
    spread = F.when(cid == "", F.concat(F.lit("\x00"), F.col(row).cast("string"))).otherwise(cid)
    seen = F.row_number().over(W.partitionBy(spread).orderBy(row))
    title, section = (given(c) if c in chunks.columns else F.lit("") for c in ("title", "section"))
    work = chunks.select(row, cid.alias("chunk_id"), lang.alias("language"), F.length(text).alias("__chars"), absent.alias("__absent"), seen.alias("__seen"), embedding_text(title, section, given("text")).alias("__e"))
    named = F.col("chunk_id") != ""
    issues = F.array(
        _issue(F.size("__absent") > 0, "error", "missing_fields", F.to_json("__absent")),
        _issue(named & (F.col("__seen") > 1), "error", "duplicate_chunk_id", F.col("chunk_id")),
        _issue(named & (F.lit(False) if language is None else F.col("language") != language), "error", "unexpected_language", F.col("language")),
        _issue(named & (F.col("__chars") < least), "warning", "short_text", F.col("__chars")),
        _issue(named & (F.col("__chars") > most), "warning", "long_text", F.col("__chars")),
        _issue(named & ~F.contains("__e", F.lit("Text:")), "error", "embedding_text_failed", F.lit("")),
    )
    return work.select(row, "chunk_id", F.inline(F.filter(issues.cast(_ISSUES), lambda x: x.isNotNull())))


def histogram(df: DataFrame, column: str, missing: str = "<missing>") -> DataFrame:
    return df.groupBy(F.coalesce(F.nullif(strip(column), F.lit("")), F.lit(missing)).alias(column)).agg(F.count("*").alias("n"))


def counts_map(df: DataFrame, column: str) -> DataFrame:
    """One row with the histogram as a map."""
    return histogram(df, column).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(column, "n")))).alias(f"{column}_counts"))


def corpus_report(chunks: DataFrame, row: str = "row_index", language: str | None = None, least: int = 40, most: int = 6000) -> DataFrame:
    """One row: counts, histograms, and whether the corpus is ready for embedding."""
    issues = corpus_issues(chunks, row, language, least, most)
    totals = chunks.agg(F.count("*").alias("chunk_count"), F.countDistinct(F.nullif(strip("chunk_id"), F.lit(""))).alias("unique_chunk_ids"))
    found = issues.agg(F.count_if(F.col("severity") == "error").alias("error_count"), F.count_if(F.col("severity") == "warning").alias("warning_count"))
    joined = totals.crossJoin(found).crossJoin(counts_map(chunks, "language")).crossJoin(counts_map(chunks, "source_type"))  # one row each
    return joined.withColumn("ready_for_common_embedding", (F.col("chunk_count") > 0) & (F.col("error_count") == 0))


def metadata_issues(metadata: DataFrame, position: str, language: str | None = None) -> DataFrame:
    """(position, severity, issue, detail) of an index's metadata; position is a row's place, which row_index must equal."""
    cid, text = given("chunk_id"), strip("text")
    spread = F.when(cid == "", F.concat(F.lit("\x00"), F.col(position).cast("string"))).otherwise(cid)
    work = metadata.withColumn("__seen", F.row_number().over(W.partitionBy(spread).orderBy(position)))
    shown = F.coalesce(F.nullif(cid, F.lit("")), F.col(position).cast("string"))
    pair = F.to_json(F.struct(F.col(position).alias("expected"), F.col("row_index").alias("actual")))
    cjk = language == "zh"
    pages = F.coalesce(F.size("source_pages"), F.lit(0)) <= 0 if "source_pages" in metadata.columns else F.lit(True)
    issues = F.array(
        _issue(~F.col("row_index").eqNullSafe(F.col(position)), "error", "metadata_row_index_mismatch", pair),
        _issue(cid == "", "error", "missing_chunk_id", F.col(position)),
        _issue((cid != "") & (F.col("__seen") > 1), "error", "duplicate_chunk_id", cid),
        _issue(text == "", "error", "empty_chunk_text", shown),
        _issue(F.lit(False) if language is None else given("language") != language, "error", "unexpected_language", cid),
        _issue(F.lit(cjk) & (given("source_path") == "" if "source_path" in metadata.columns else F.lit(True)), "error", "missing_source_path", cid),
        _issue(F.lit(cjk) & pages, "error", "missing_source_pages", cid),
        _issue(given("title") == "" if "title" in metadata.columns else F.lit(True), "warning", "missing_title", shown),
    )
    return work.select(position, F.inline(F.filter(issues.cast(_ISSUES), lambda x: x.isNotNull())))


def vector_report(vectors: DataFrame, vector: str = "embedding", tolerance: float = 1e-3) -> DataFrame:
    """One row: count, dimensions, norms, and whether all is finite and of unit length."""
    n = norm(vector)
    return vectors.select(F.size(vector).alias("d"), n.alias("n"), is_finite(vector).alias("ok")).agg(
        F.count("*").alias("chunk_count"),
        F.max("d").alias("embedding_dim"),
        F.coalesce(F.max("d") == F.min("d"), F.lit(False)).alias("one_dimension"),
        F.min("n").alias("norm_min"),
        F.max("n").alias("norm_max"),
        F.coalesce(F.bool_and("ok"), F.lit(True)).alias("finite"),
        F.coalesce(F.bool_and(F.abs(F.col("n") - 1) <= tolerance + 1e-5), F.lit(True)).alias("unit_length"),
    )


def sample_rows(count: int) -> list[int]:
    """The first, the middle and the last row."""
    return sorted({0, count // 2, count - 1}) if count > 0 else []


def reconstruction_error(vectors: DataFrame, index: DataFrame, rows: Sequence[int], row: str = "row_index", vector: str = "embedding") -> DataFrame:
    """One row: the largest difference between the sampled vectors at unit length and what the index holds."""
    a = vectors.where(F.col(row).isin(list(rows))).select(row, unit(vector).alias("a"))
    b = index.where(F.col(row).isin(list(rows))).select(row, F.col(vector).alias("b"))
    gap = F.array_max(F.zip_with("a", "b", lambda x, y: F.abs(x - y.cast("double"))))
    return a.join(b, row).agg(F.max(gap).alias("sample_reconstruction_max_error"))


def manifest_issues(manifests: dict[str, dict], count: int, dimensions: int) -> list[dict]:
    """Differences between what manifests claim and what there is."""
    found = []
    for name, manifest in manifests.items():
        for field, actual, issue in (("chunk_count", count, "chunk_count_mismatch"), ("embedding_dim", dimensions, "dimension_mismatch")):
            if int(manifest.get(field, -1)) != actual:
                found.append({"severity": "error", "issue": f"{name}_{issue}", "detail": json.dumps({"expected": actual, "actual": manifest.get(field)})})
    return found


def index_report(vectors: DataFrame, metadata: DataFrame, index: DataFrame, manifests: dict[str, dict], row: str = "row_index", language: str | None = None) -> DataFrame:
    """One row for an index as a whole, with its issues as an array. Only one-row aggregates come to the driver."""
    spark = vectors.sparkSession
    v, i = vector_report(vectors).first(), vector_report(index).first()
    n_meta = metadata.count()
    found = []

    def add(issue: str, detail) -> None:
        found.append(("error", issue, json.dumps(detail)))

    if not v["chunk_count"]:
        add("empty_embeddings", 0)
    if v["chunk_count"] != n_meta:
        add("embedding_metadata_count_mismatch", {"embeddings": v["chunk_count"], "metadata": n_meta})
    if not v["finite"]:
        add("non_finite_embedding_values", True)
    if not v["unit_length"]:
        add("embedding_norm_mismatch", {"minimum": v["norm_min"], "maximum": v["norm_max"]})
    if i["chunk_count"] != v["chunk_count"]:
        add("index_count_mismatch", {"expected": v["chunk_count"], "actual": i["chunk_count"]})
    if i["embedding_dim"] != v["embedding_dim"]:
        add("index_dimension_mismatch", {"expected": v["embedding_dim"], "actual": i["embedding_dim"]})
    elif i["chunk_count"] == v["chunk_count"] and v["chunk_count"]:
        worst = reconstruction_error(vectors, index, sample_rows(v["chunk_count"]), row).first()[0]
        if worst is None or worst > 1e-4:
            add("index_reconstruction_mismatch", worst)
    found += [(x["severity"], x["issue"], x["detail"]) for x in manifest_issues(manifests, v["chunk_count"], v["embedding_dim"] or 0)]
    issues = metadata_issues(metadata, "position", language) if "position" in metadata.columns else metadata_issues(metadata.withColumn("position", F.col(row)), "position", language)
    whole = spark.createDataFrame(found, "severity string, issue string, detail string").unionByName(issues.select("severity", "issue", "detail"))
    counts = whole.agg(F.count_if(F.col("severity") == "error").alias("error_count"), F.count_if(F.col("severity") == "warning").alias("warning_count"), F.array_sort(F.collect_set("issue")).alias("issues"))
    return counts.select(F.lit(v["chunk_count"]).alias("chunk_count"), F.lit(v["embedding_dim"]).alias("embedding_dim"), "error_count", "warning_count", "issues", (F.col("error_count") == 0).alias("ready_for_retrieval"))


def smoke_results(queries: DataFrame, hits: DataFrame, by: str = "query_id") -> DataFrame:
    """Per query (query_id, query, expected_any): keywords found in its hits, hits that can't be traced, and whether it passes."""
    text = F.lower(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", F.concat(given("title"), F.lit("\n"), given("section"), F.lit("\n"), given("text")).alias("t")))), lambda x: x["t"]), "\n"))
    untraced = F.when((given("source_path") == "") | (F.coalesce(F.size("source_pages"), F.lit(0)) <= 0), F.struct("rank", F.coalesce(F.nullif(given("chunk_id"), F.lit("")), F.col("row_index").cast("string")).alias("c")))
    grouped = hits.groupBy(by).agg(text.alias("__t"), F.count("*").alias("result_count"), F.transform(F.array_sort(F.collect_list(untraced)), lambda x: x["c"]).alias("missing_traceability"))
    joined = queries.join(grouped, by, "left")
    matched = F.filter(F.filter("expected_any", lambda k: k != ""), lambda k: F.contains(F.coalesce("__t", F.lit("")), F.lower(k)))
    missing = F.coalesce("missing_traceability", F.array().cast("array<string>"))
    out = joined.select(by, "query", "expected_any", matched.alias("matched_keywords"), F.coalesce("result_count", F.lit(0)).alias("result_count"), missing.alias("missing_traceability"))
    return out.withColumn("passed", (F.col("result_count") > 0) & (F.size("matched_keywords") > 0) & (F.size("missing_traceability") == 0))


def smoke_totals(results: DataFrame) -> DataFrame:
    return results.agg(F.count("*").alias("query_count"), F.count_if("passed").alias("passed_count"), F.count_if(~F.col("passed")).alias("failed_count"), F.coalesce(F.bool_and("passed"), F.lit(True)).alias("all_passed"))

"""Bibliographic registries: source tagging, merging by one key, keep-first combination, projections for the index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.functions.text import article_key, col, fold, given, slug, strip

#: Columns of a registry in their order; what else a source has follows.
FIELDS = tuple("pmid pmcid title year journal doi abstract source_url".split()) + tuple("disease_type topic study_type evidence_level has_full_text".split())
#: (name, default) of what the index keeps about a chunk; array columns default to empty.
METADATA = (
    "chunk_id document_id language source_type pmcid pmid doi title journal year section chunk_index source_url source_path source_paragraph_indices source_pages "
    "page_start page_end extraction_methods sentence_start sentence_end word_count text_unit_count char_count text"
).split()
_LISTS = {"source_paragraph_indices": "array<int>", "source_pages": "array<int>", "extraction_methods": "array<string>"}
_NUMBERS = {"chunk_index", "page_start", "page_end", "sentence_start", "sentence_end", "word_count", "text_unit_count", "char_count"}


def dedupe_key(pmid: str | Column = "pmid", doi: str | Column = "doi", title: str | Column = "title") -> Column:
    """The one key of a record: pmid, else doi, else folded title; rows with none of them share the empty title."""
    p, d = strip(pmid), F.lower(strip(doi))
    return F.when(p != "", F.concat(F.lit("pmid:"), p)).when(d != "", F.concat(F.lit("doi:"), d)).otherwise(F.concat(F.lit("title:"), fold(F.lower(given(title)))))


def tag_source(df: DataFrame, name: str, rank: int) -> DataFrame:
    """A source's rows with trimmed strings, a normal article number, and the source's name and rank."""
    clean = [(article_key(c) if c == "pmcid" else strip(c)).alias(c) for c in df.columns]
    return df.select(*clean, F.lit(name).alias("source_name"), F.lit(rank).alias("source_rank"))


def merge(df: DataFrame, seq: str = "seq", fields: Sequence[str] = FIELDS, name: str = "source_name", rank: str = "source_rank") -> DataFrame:
    """One row for each key: of every field the first value that is not empty, by seq, and the sources in rank order.

    One grouping; values are combined on the map side.
    """
    keyed = df.select(dedupe_key().alias("dedupe_key"), seq, name, rank, *(given(f).alias(f) for f in fields))
    first = [F.coalesce(F.expr(f"min_by({f}, {seq}) FILTER (WHERE trim({f}) <> '')"), F.lit("")).alias(f) for f in fields]
    sources = F.array_sort(F.collect_set(F.struct(F.col(rank).alias("rank"), F.col(name).alias("name"))))
    merged = keyed.groupBy("dedupe_key").agg(*first, F.min(seq).alias("first_seq"), sources.alias("__sources"))
    return merged.withColumn("source_queries", F.array_join(F.transform("__sources", lambda s: s["name"]), ";")).withColumn("source_query_count", F.size("__sources").cast("string")).drop("__sources")


def summary(merged: DataFrame) -> DataFrame:
    """(measure, n): totals of a merged registry, and rows for each source."""
    totals = merged.agg(
        F.count("*").alias("total"),
        F.count_if(F.trim(given("pmcid")) != "").alias("with_pmcid"),
        F.count_if(F.trim(given("doi")) != "").alias("with_doi"),
        F.count_if(F.coalesce(F.expr("try_cast(source_query_count AS int)"), F.lit(0)) > 1).alias("multi_source"),
    )
    names = ("total", "with_pmcid", "with_doi", "multi_source")
    wide = totals.select(F.explode(F.array(*(F.struct(F.lit(n).alias("measure"), F.col(n).alias("n")) for n in names))).alias("x")).select("x.*")
    by_source = merged.select(F.explode(F.split("source_queries", ";")).alias("s")).where("s <> ''").groupBy(F.concat(F.lit("source:"), F.col("s")).alias("measure")).agg(F.count("*").alias("n"))
    return wide.unionByName(by_source)


def combine(parts: Sequence[DataFrame], seq: str = "seq", default_type: str = "pmc_full_text") -> DataFrame:
    """Chunks of several sources in order, of each chunk_id the first; blank ids are never duplicates."""
    whole = None
    for k, part in enumerate(parts):
        part = part.withColumn("part", F.lit(k))
        whole = part if whole is None else whole.unionByName(part, allowMissingColumns=True)
    if "source_type" not in whole.columns:
        whole = whole.withColumn("source_type", F.lit(""))
    blank = given("chunk_id") == ""
    # Blank ids spread by their place instead of meeting in one task.
    spread = F.when(blank, F.concat_ws(":", F.lit("\x00"), "part", seq)).otherwise(F.col("chunk_id"))
    first = F.row_number().over(W.partitionBy(spread).orderBy("part", seq))
    kept = whole.withColumn("__n", first).where(blank | (F.col("__n") == 1)).drop("__n")
    return kept.withColumn("source_type", F.coalesce(F.nullif(given("source_type"), F.lit("")), F.lit(default_type)))


def repeated_ids(df: DataFrame, id_col: str, order: Sequence[str]) -> DataFrame:
    """Second and later rows of each id."""
    return df.withColumn("occurrence", F.row_number().over(W.partitionBy(id_col).orderBy(*order))).where("occurrence > 1")


def embedding_text(title: str | Column = "title", section: str | Column = "section", text: str | Column = "text") -> Column:
    """What is encoded of a chunk; identifiers never are."""
    t, s = fold(title), fold(section)
    return F.concat_ws("\n", F.when(t != "", F.concat(F.lit("Title: "), t)), F.when(s != "", F.concat(F.lit("Section: "), s)), F.concat(F.lit("Text: "), fold(text)))


def metadata(chunks: DataFrame, row_index: str = "row_index") -> DataFrame:
    """The fixed projection that lies beside an index; absent columns take their defaults."""
    out = [F.col(row_index).alias("row_index")]
    for c in METADATA:
        if c in _LISTS:
            value = F.coalesce(F.col(c).cast(_LISTS[c]), F.array().cast(_LISTS[c])) if c in chunks.columns else F.array().cast(_LISTS[c])
        elif c in _NUMBERS:
            value = F.col(c).cast("int") if c in chunks.columns else F.lit(None).cast("int")
        elif c == "source_type":
            value = F.coalesce(F.col(c), F.lit("unknown")) if c in chunks.columns else F.lit("unknown")
        else:
            value = given(c) if c in chunks.columns else F.lit("")
        out.append(value.alias(c))
    return chunks.select(*out)


def record_identifier(pmid: str | Column = "pmid", doi: str | Column = "doi", title: str | Column = "title") -> Column:
    """Prefix of an abstract's chunk ids."""
    p, d, t = fold(pmid), fold(doi), fold(title)
    return F.when(p != "", F.concat(F.lit("PMID"), p)).when(d != "", F.concat(F.lit("DOI"), slug(d, "doi"))).otherwise(F.concat(F.lit("TITLE"), slug(t, "untitled")))


def abstract_only(df: DataFrame, include_with_full_text: bool = False) -> DataFrame:
    """Records whose abstract is to be chunked: those without full text."""
    some = fold("abstract") != ""
    return df.where(some if include_with_full_text else some & (article_key("pmcid") == ""))


def cell(x: str | Column) -> Column:
    """A value as one line of a CSV cell."""
    return fold(x)


DECISION = tuple(f"filter_{x}" for x in "decision include_score exclude_score include_matches exclude_matches review_reason".split())
VIEW = (*FIELDS[:6], "has_full_text", "source_queries", "source_query_count", *DECISION, "source_url")
VIEW_CJK = ("document_id", "title", *(f"{x}_{y}" for x, y in (("page", "count"), ("native", "pages"), ("ocr", "pages"))), *DECISION, "source_path")


def view(df: DataFrame, columns: Sequence[str] = VIEW, abstract: str = "abstract", most: int = 500) -> DataFrame:
    """Readable extract: single-line cells, and the abstract's beginning where there is one."""
    out = [cell(F.col(c).cast("string")).alias(c) for c in columns if c in df.columns]
    if abstract in df.columns:
        out.append(F.substring(cell(col(abstract)), 1, most).alias("abstract_excerpt"))
    return df.select(*out)

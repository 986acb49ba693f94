"""The second pass as a whole: records with their chunks, scored against anchors, decided, and routed; and small operators over inputs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark import vocab
from quillspark.functions.text import given, normalize
from quillspark.operators import semantic as S

#: What an audit says about a record that the first pass had excluded.
NOT_CHECKED = ("not_checked_existing_exclude", "excluded", "already excluded by first-pass medical rules")
#: Fewest anchors of each label that a pass is run with.
LEAST_ANCHORS = 8
_STATS = {"chunk_count": "bigint", "animal_hits": "bigint", "animal_ratio": "double", "lexical_hits": "bigint", "max_animal_score": "double", "mean_animal_score": "double", "mean_human_score": "double", "mean_margin": "double"}


def with_status(**parts: DataFrame) -> DataFrame:
    """The rows of several tables, each with the name it was given under as its status."""
    whole = None
    for status, part in parts.items():
        part = part.withColumn("status", F.lit(status))
        whole = part if whole is None else whole.unionByName(part, allowMissingColumns=True)
    return whole


def first_rows(df: DataFrame, n: int | None, order: Sequence[str | Column]) -> DataFrame:
    """The first n rows in an order; all without n. This limit is the feature: it is what a trial run asks for."""
    if n is None:
        return df
    if n <= 0:
        raise ValueError("a limit must be greater than zero")
    return df.orderBy(*order).limit(n)


def selected(df: DataFrame, part: str | None, *columns: str) -> DataFrame:
    """Rows one of whose columns holds the given text, whatever its case; all without one."""
    if not part:
        return df
    found = F.lit(False)
    for c in columns:
        found = found | F.contains(F.lower(given(c)), F.lit(part.lower()))
    return df.where(found)


def by_name(df: DataFrame, path: str = "path") -> DataFrame:
    """Files in the order of their folded names; equal ones by the name itself."""
    name = F.element_at(F.split(path, "/"), -1)
    return df.orderBy(F.lower(name), name)


def registry_record(totals: DataFrame) -> DataFrame:
    """Registry rows of parsed documents (document_id, title, source_path, page_count, native_pages, ocr_pages, low_text_pages, status); failed ones have none."""
    blank = [F.lit("").alias(c) for c in ("journal", "year", "authors", "doi", "keywords", "abstract")]
    kept = totals.where(~F.startswith(given("status"), F.lit("failed")))
    return kept.select(
        "document_id", "title", F.lit("zh").alias("language"), F.lit("cnki_pdf").alias("source_type"), "source_path", "page_count", "native_pages", "ocr_pages", F.col("low_text_pages").alias("empty_pages"), F.col("status").alias("parse_status"), *blank
    )


def assess_records(records: DataFrame, chunks: DataFrame, anchors: DataFrame, encode: Callable[[Column], Column], t: S.Thresholds = S.Thresholds(), record: str = "record_id", seq: str = "seq") -> DataFrame:
    """records (with status) and the second pass's decision: statistics of their chunks' similarity to anchors, decision, final status, reason.

    Chunks are found by any identifier, an abstract stands in where there are none. Anchors (label, text) of both labels are needed. Every text is
    encoded once, in batches where it lies, however many records share it; only scores are joined with records.
    """
    held = anchors.select("label", encode(F.col("text")).alias("embedding"))
    if {r["label"] for r in anchors.groupBy("label").count().collect()} < {"animal", "human"}:  # two rows at most
        raise ValueError("anchors of both labels are needed")

    def score(texts: DataFrame) -> DataFrame:
        texts = texts.withColumn("__t", S.semantic_text(texts)).withColumn("embedding", encode(F.col("__t")))
        for label in ("animal", "human"):
            texts = S.top_mean_similarity(texts, held.where(F.col("label") == label), t.anchors, into=f"{label}_score")
        texts = texts.withColumn("lexical", vocab.ANIMAL.any(normalize("__t")))
        return texts.withColumn("is_animal", S.is_animal("animal_score", "human_score", F.col("lexical"), t))

    scored = S.scores_of_records(records, chunks, score, ("animal_score", "human_score", "lexical", "is_animal"), record, seq)
    titled = records.withColumns({"title_animal_terms": vocab.ANIMAL.found(normalize("title")), "title_human_terms": vocab.HUMAN_TITLE.found(normalize("title"))})
    return S.decide_articles(titled.join(S.article_stats(scored, [record]), record, "left"), t)


def annotate(assessed: DataFrame, excluded: DataFrame) -> DataFrame:
    """All records with final status: those assessed, and those that the first pass had excluded, which are not checked again."""
    decision, status, reason = (F.lit(x) for x in NOT_CHECKED)
    none = F.array().cast("array<string>")
    old = excluded.withColumns({"status": F.lit("excluded"), "semantic_decision": decision, "semantic_final_status": status, "semantic_reason": reason, "title_animal_terms": none, "title_human_terms": none})
    old = old.withColumns({c: F.lit(0).cast(kind) for c, kind in _STATS.items()})
    return assessed.unionByName(old, allowMissingColumns=True)


def decisions(assessed: DataFrame, seq: str = "seq") -> DataFrame:
    """(id, decision): for each identifier of the assessed records the decision of the last record that has it."""
    each = assessed.select(seq, F.struct("semantic_decision", "semantic_final_status").alias("d"), F.explode(S.own_ids(assessed)).alias("x")).select(seq, "d", "x.id")
    return each.groupBy("id").agg(F.max_by("d", seq).alias("decision"))


def route(chunks: DataFrame, assessed: DataFrame, key: Sequence[str], seq: str = "seq") -> DataFrame:
    """chunks (with bucket) and final_bucket by the decision of the first of their identifiers that an assessed record has."""
    each = chunks.select(*key, F.explode(S.own_ids(chunks)).alias("x")).select(*key, "x.prio", "x.id")
    found = each.join(decisions(assessed, seq), "id").groupBy(*key).agg(F.min_by("decision", "prio").alias("__d"))
    told = chunks.join(found, list(key), "left").withColumns({"semantic_decision": F.col("__d.semantic_decision"), "semantic_final_status": F.col("__d.semantic_final_status")})
    return S.reroute(told.drop("__d"))

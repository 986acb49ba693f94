"""The queries of this subpackage and their SQL, as the entry module registers them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import bpe, decontam, exactdup, jaccard, linededup, lmscore, quality, suffixdedup, toxicity
from quillspark.llm.common import table


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.count_tokens(table(spark, sf_dir, "documents"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that the classifier keeps, with their scores; quality.score has the rejected ones too."""
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).where("keep").select("doc_id", "score")


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, sf_dir, "documents"))


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's spans as lists of where they begin and where they end."""
    found = suffixdedup.repeated_spans(table(spark, sf_dir, "documents"))
    edges = [F.col(kind)[edge].alias(f"{kind}_{edge}") for kind in ("repeated", "removable") for edge in ("start", "stop")]
    return found.select("doc_id", *edges, "n_words")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_deleted")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdup.exact_copies(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that are toxic; toxicity.score_toxicity has the scores of all."""
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).where("toxic").select("doc_id", "score", "terms")


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.lm_scores(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_byte_bpe,
        op2_token_counts,
        op3_quality_classifier,
        op4_ngram_jaccard_join,
        op5_suffix_array_dedup,
        op6_line_dedup,
        op7_exact_dedup,
        op8_toxicity,
        op9_benchmark_decontamination,
        op10_lm_scoring,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op4_ngram_jaccard_join": jaccard.SQL,
        "op5_suffix_array_dedup": suffixdedup.SQL,
        "op6_line_dedup": linededup.SQL.format(table="documents", min_chars=linededup.MIN_CHARS),
        "op7_exact_dedup": exactdup.SQL,
    }

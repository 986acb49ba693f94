"""The corpus pipeline: documents in, token lists of the clean and distinct ones out.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept, and returns the columns
of documents (the last returns tokens). :func:`run` writes what each stage returns to the shared folder and reads it again for the next,
so that an executor's loss costs no more than the stage at hand.

Rows with null or repeated doc_ids, null and empty texts, and extra columns pass every stage by the rules in its operator's
docstring: what can't be judged is kept, and extra columns are carried to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import bpe, decontam, jaccard, linededup, quality
from quillspark.llm.common import clean, release, table, unused, written

#: Identifiers of contaminated documents (8 bytes each) that may be sent to all tasks; more are joined by a shuffle.
MOST_SENT = 1_000_000


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are deleted; a document that has lost all its lines goes, one that had none stays.

    n_chars follows the text where there is such a column; columns of any other name are carried as they are.
    """
    lines, deleted, reach = unused(docs.columns, *linededup.COUNTS)
    done = linededup.dedup_lines(docs, counts=(lines, deleted, reach)).where(f"`{lines}` is null or `{lines}` = 0 or `{deleted}` < `{lines}`")
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return done.select(*(f"`{c}`" for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of least doc_id, of each group connected by n-gram Jaccard pairs."""
    return jaccard.drop_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, re-parameterised or not."""
    [mark] = unused(docs.columns, "__hit")
    hit = written(decontam.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias(mark)).distinct(), "hits")
    few = hit.limit(MOST_SENT + 1).count() <= MOST_SENT
    return docs.join(F.broadcast(hit) if few else hit, docs["doc_id"].cast("bigint") == hit[mark], "left_anti")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE tokens of every document left."""
    return bpe.encode_documents(docs)


STAGES = [
    ("quality_classifier", quality_filter),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontaminate),
    ("byte_bpe", encode),
]

#: SQL can't express the classifier's training or the encoding; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of the documents that are left. What stages have written goes as soon as the next one's documents are there."""
    docs, first = table(spark, sf_dir, "documents"), clean(spark, since=1 << 60)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
        clean(spark, first, keep=1)
        release(spark)
    return STAGES[-1][1](spark, docs, sf_dir)

"""Exact retrieval: unit vectors beside their metadata, top-k by inner product, evidence and prompts."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.functions.text import given
from quillspark.functions.vectors import unit

#: Functions of this module travel whole, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOP_K = 8
#: Query vectors that may be sent to every task; a larger set meets the index block by block instead.
MOST_SENT = 10_000
#: Vectors of a block.
BLOCK = 4096


def build_index(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """The table with unit vectors; a zero vector stays zero."""
    return embeddings.withColumn(vector, unit(vector))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _best(place: np.ndarray, score: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of (query, score, row) triples the k best of each query: the highest scores, then the lowest rows."""
    order = np.lexsort((row, -score, place))
    place, score, row = place[order], score[order], row[order]
    begins = np.flatnonzero(np.r_[True, place[1:] != place[:-1]]) if len(place) else place
    rank = np.arange(len(place)) - np.repeat(begins, np.diff(np.r_[begins, len(place)]))
    return place[rank < k], score[rank < k], row[rank < k]


def _hopeful(products: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Triples of a (queries, rows) matrix that may be among the k best."""
    products = np.round(products, 9)  # sums in another order must not break ties
    if products.shape[1] > k:
        place, at = np.nonzero(products >= np.partition(products, products.shape[1] - k, axis=1)[:, products.shape[1] - k, None])
    else:
        place, at = (x.ravel() for x in np.indices(products.shape))
    return place, products[place, at], rows[at]


def search(index: DataFrame, queries: DataFrame, k: int = TOP_K, query_id: str = "query_id", row: str = "row_index", vector: str = "embedding", most_sent: int = MOST_SENT) -> DataFrame:
    """(query_id, row_index, score, rank): the k rows of greatest inner product for every query; ties (to nine places) by row.

    A batch of rows meets a block of queries in one matrix product, and a task keeps k rows for each query. Queries are sent to the index's partitions when their
    number allows; else both sides are packed into blocks of at most ``BLOCK`` vectors and every pair of blocks is one product. Null vectors are found by nothing.
    """
    spark, row_kind, id_kind = index.sparkSession, index.schema[row].dataType, queries.schema[query_id].dataType.simpleString()
    schema = f"{query_id} {id_kind}, {row} bigint, __s double"
    have = index.select(F.col(row).cast("bigint").alias(row), vector).where(F.col(vector).isNotNull())
    asked = queries.select(query_id, F.col(vector).alias("__q")).where("__q is not null")
    if asked.limit(most_sent + 1).count() <= most_sent:
        sent = asked.toArrow().combine_chunks()  # at most most_sent vectors
        if not sent.num_rows:
            return spark.createDataFrame([], schema).select(query_id, F.col(row).cast(row_kind), F.col("__s").alias("score"), F.lit(1).alias("rank")).limit(0)
        shared = spark.sparkContext.broadcast((sent[query_id].combine_chunks(), _matrix(sent["__q"].combine_chunks())))

        def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, matrix = shared.value
            held = (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))
            for batch in batches:
                for at in range(0, batch.num_rows, BLOCK):
                    part = batch.slice(at, BLOCK)
                    found = _hopeful(matrix @ _matrix(part.column(1)).T, part.column(0).to_numpy(), k)
                    held = _best(*(np.concatenate(x) for x in zip(held, found)), k)
            if len(held[0]):
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(held[0])), pa.array(held[2]), pa.array(held[1])], [query_id, row, "__s"])

        scored = have.mapInArrow(nearest, schema)
    else:

        def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, BLOCK):
                    part = batch.slice(at, BLOCK)
                    ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), pa.concat_arrays([part.column(0)]))
                    yield pa.RecordBatch.from_arrays([ids, pa.array([_matrix(part.column(1)).tobytes()], pa.binary())], ["ids", "vectors"])

        def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                have_ids, vectors, asked_ids, questions = batch.columns
                for n in range(batch.num_rows):
                    rows, ids = have_ids[n].values.to_numpy(), asked_ids[n].values
                    a, b = (np.frombuffer(c[n].as_py(), np.float64).reshape(size, -1) for c, size in ((questions, len(ids)), (vectors, len(rows))))
                    place, score, at = _best(*_hopeful(a @ b.T, rows, k), k)
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(place)), pa.array(at), pa.array(score)], [query_id, row, "__s"])

        blocks, questions = (df.mapInArrow(packed, f"ids array<{kind}>, vectors binary") for df, kind in ((have, "bigint"), (asked, id_kind)))
        scored = blocks.crossJoin(questions.withColumnsRenamed({"ids": "query_ids", "vectors": "query_vectors"})).mapInArrow(met, schema)
    w = W.partitionBy(query_id).orderBy(F.desc("__s"), row)
    best = scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return best.select(query_id, F.col(row).cast(row_kind), F.round("__s", 6).alias("score"), "rank")


def with_metadata(hits: DataFrame, metadata: DataFrame, row: str = "row_index") -> DataFrame:
    """Hits and what lies at their rows; a hit without a row fails the job."""
    joined = hits.join(metadata.withColumn("__found", F.lit(True)), row, "left")
    checked = F.when(F.col("__found").isNull(), F.raise_error(F.concat(F.lit("no metadata at row "), F.col(row).cast("string")))).otherwise(F.col(row))
    return joined.withColumn(row, checked.cast(hits.schema[row].dataType)).drop("__found")


def citation(pmcid: str | Column = "pmcid", year: str | Column = "year", title: str | Column = "title", section: str | Column = "section") -> Column:
    return F.concat_ws(" | ", *(F.nullif(given(x), F.lit("")) for x in (pmcid, year, title, section)))


EVIDENCE = ("evidence_id", "rank", "score", "chunk_id", "source_type", "pmcid", "pmid", "doi") + ("title", "journal", "year", "section", "source_url", "citation", "text")


def evidence(hits: DataFrame, by: str = "query_id") -> DataFrame:
    """Numbered evidence of each query's hits; columns they lack are empty."""
    have = hits
    for c in EVIDENCE:
        if c not in have.columns and c not in ("evidence_id", "citation"):
            have = have.withColumn(c, F.lit(""))
    place = F.row_number().over(W.partitionBy(by).orderBy("rank"))
    return have.withColumn("evidence_id", F.concat(F.lit("E"), place.cast("string"))).withColumn("citation", citation()).select(by, *EVIDENCE)


PROMPT_HEAD = """角色：医学文献问答助手。规则如下。
- 证据范围：只用 Evidence 部分的材料，外部知识一律不用。
- 引用：关键结论都要带编号，如 [E1]。
- 不足：材料不够时直接写明证据不足。
- 安全：只总结文献，不替任何患者作诊断或治疗决定。
- 分歧：证据互相矛盾时写明不确定性。

Question:
"""
PROMPT_TAIL = """

输出三部分：简短结论；证据依据；不确定性或不足。
"""


def prompts(questions: DataFrame, found: DataFrame, by: str = "query_id", question: str = "question") -> DataFrame:
    """(query_id, question, evidence_count, prompt) of every question, with or without evidence."""
    number = F.expr("int(substring(evidence_id, 2))")
    block = F.concat(
        F.lit("["), F.col("evidence_id"), F.lit("] "), F.col("citation"), F.lit("\nScore: "), F.col("score").cast("string"), F.lit("\nChunk: "), F.col("chunk_id"), F.lit("\nText: "), F.col("text")
    )
    blocks = found.groupBy(by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(number.alias("n"), block.alias("b")))), lambda x: x["b"]), "\n\n").alias("__e"), F.count("*").alias("__n"))
    joined = questions.join(blocks, by, "left")
    text = F.concat(F.lit(PROMPT_HEAD), F.col(question), F.lit("\n\nEvidence:\n"), F.coalesce("__e", F.lit("No evidence retrieved.")), F.lit(PROMPT_TAIL))
    return joined.select(by, question, F.coalesce("__n", F.lit(0)).alias("evidence_count"), text.alias("prompt"))

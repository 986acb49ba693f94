"""Queries over vectors: exact top-k, hits with metadata, checks of corpora and indexes, smoke tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.operators import retrieval as R
from quillspark.operators import validate as V
from quillspark.plans import query, table

_UNIT_SQL = "u AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE / sqrt(list_inner_product(list_transform(embedding, lambda y: y::DOUBLE), list_transform(embedding, lambda y: y::DOUBLE)))) AS e FROM embeddings)"
_TOP_SQL = f"""WITH {_UNIT_SQL}, p AS (SELECT q.vec_id AS query_id, u.vec_id AS row_index, list_inner_product(u.e, q.e) AS s FROM u CROSS JOIN u q WHERE q.vec_id % 100 = 0),
top AS (SELECT * FROM (SELECT query_id, row_index, round(s, 6) AS score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(s, 9) DESC, row_index) AS INTEGER) AS rank FROM p) WHERE rank <= 8)"""


def _top(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = R.build_index(table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("row_index"), "embedding"))
    return R.search(index, index.where("row_index % 100 = 0").withColumnRenamed("row_index", "query_id"))  # the stated query set, against all rows


@query(f"{_TOP_SQL} SELECT * FROM top")
def q24_topk_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top(spark, sf_dir)


@query(f"""{_TOP_SQL}, m AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS row_index, concat('D', doc_id) AS chunk_id, source AS journal FROM documents)
SELECT query_id, row_index, score, rank, label, coalesce(chunk_id, '') AS chunk_id, coalesce(journal, '') AS journal FROM top JOIN embeddings e ON e.vec_id = top.row_index LEFT JOIN m USING (row_index)""")
def q25_ranked_hits_with_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillspark.storage import with_row_number

    docs = with_row_number(table(spark, sf_dir, "documents").select("doc_id", "source"), ["doc_id"])
    notes = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("row_index"), "label").join(docs, "row_index", "left")
    notes = notes.select("row_index", "label", F.coalesce(F.concat(F.lit("D"), "doc_id"), F.lit("")).alias("chunk_id"), F.coalesce("source", F.lit("")).alias("journal"))
    return R.with_metadata(_top(spark, sf_dir), notes).select("query_id", "row_index", "score", "rank", "label", "chunk_id", "journal")


_CORPUS = """SELECT doc_id AS row_index, CASE WHEN doc_id % 40 = 0 THEN '' ELSE concat('D', doc_id % 700) END AS chunk_id, CASE WHEN doc_id % 30 = 0 THEN '' ELSE substr(text, 1, 20) END AS title,
  CASE WHEN doc_id % 60 = 1 THEN 'zh' ELSE lang END AS language, source AS source_type, CASE WHEN doc_id % 25 = 0 THEN '' ELSE source END AS source_path, text, CAST(doc_id % 4 AS INTEGER) AS page_start, 1 AS page_end FROM documents"""
_TITLE = "trim(title)"


@query(f"""WITH c AS ({_CORPUS}), n AS (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY row_index) AS seen, length(trim(text, ' ' || chr(9) || chr(10) || chr(13))) AS chars,
  list_sort(list_filter([CASE WHEN chunk_id = '' THEN 'chunk_id' END, CASE WHEN title = '' THEN 'title' END, CASE WHEN source_path = '' THEN 'source_path' END, CASE WHEN text = '' THEN 'text' END,
    CASE WHEN language = 'zh' THEN 'document_id' END, CASE WHEN language = 'zh' THEN 'source_pages' END, CASE WHEN language = 'zh' THEN 'extraction_methods' END,
    CASE WHEN language = 'zh' AND page_start = 0 THEN 'page_start' END], lambda z: z IS NOT NULL)) AS absent FROM c)
SELECT row_index, chunk_id, 'error' AS severity, 'missing_fields' AS issue, concat('["', array_to_string(absent, '","'), '"]') AS detail FROM n WHERE len(absent) > 0
UNION ALL SELECT row_index, chunk_id, 'error', 'duplicate_chunk_id', chunk_id FROM n WHERE chunk_id <> '' AND seen > 1
UNION ALL SELECT row_index, chunk_id, 'error', 'unexpected_language', language FROM n WHERE chunk_id <> '' AND language <> 'en'
UNION ALL SELECT row_index, chunk_id, 'warning', 'short_text', chars::VARCHAR FROM n WHERE chunk_id <> '' AND chars < 200
UNION ALL SELECT row_index, chunk_id, 'warning', 'long_text', chars::VARCHAR FROM n WHERE chunk_id <> '' AND chars > 6000""")
def q30_corpus_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = spark.sql(_CORPUS.replace("FROM documents", "FROM {t}"), t=table(spark, sf_dir, "documents"))
    return V.corpus_issues(chunks, language="en", least=200)


@query("""WITH v AS (SELECT len(embedding) AS d, sqrt(list_inner_product(list_transform(embedding, lambda y: y::DOUBLE), list_transform(embedding, lambda y: y::DOUBLE))) AS n FROM embeddings)
SELECT count(*) AS chunk_count, CAST(max(d) AS INTEGER) AS embedding_dim, max(d) = min(d) AS one_dimension, round(min(n), 5) AS norm_min, round(max(n), 5) AS norm_max, true AS finite, bool_and(abs(n - 1) <= 0.00101) AS unit_length FROM v""")
def q31_index_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.vector_report(table(spark, sf_dir, "embeddings")).withColumns({"norm_min": F.round("norm_min", 5), "norm_max": F.round("norm_max", 5)})


@query(f"""{_TOP_SQL}, m AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS row_index, substr(text, 1, 40) AS title, source AS section, text, CASE WHEN doc_id % 20 = 3 THEN '' ELSE lang END AS source_path FROM documents),
h AS (SELECT top.*, m.* EXCLUDE row_index FROM top JOIN m USING (row_index)),
g AS (SELECT query_id, count(*) AS result_count, lower(string_agg(concat(title, chr(10), section, chr(10), text), chr(10) ORDER BY rank)) AS t, coalesce(list(row_index::VARCHAR ORDER BY rank) FILTER (WHERE source_path = ''), []) AS missing FROM h GROUP BY query_id),
q AS (SELECT vec_id AS query_id, ['That The', concat('src', label)] AS expected FROM embeddings WHERE vec_id % 100 = 0),
r AS (SELECT query_id, coalesce(result_count, 0) AS result_count, list_filter(expected, lambda k: contains(coalesce(t, ''), lower(k))) AS matched_keywords, coalesce(missing, []) AS missing_traceability FROM q LEFT JOIN g USING (query_id))
SELECT *, result_count > 0 AND len(matched_keywords) > 0 AND len(missing_traceability) = 0 AS passed FROM r""")
def q32_retrieval_smoke(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillspark.storage import with_row_number

    docs = with_row_number(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), ["doc_id"])
    notes = docs.select("row_index", F.lit("").alias("chunk_id"), F.substring("text", 1, 40).alias("title"), F.col("source").alias("section"), "text", F.when(F.col("doc_id") % 20 == 3, "").otherwise(F.col("lang")).alias("source_path"), F.array(F.lit(1)).alias("source_pages"))
    hits = _top(spark, sf_dir).join(notes, "row_index")
    asked = table(spark, sf_dir, "embeddings").where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.lit("").alias("query"), F.array(F.lit("That The"), F.concat(F.lit("src"), "label")).alias("expected_any"))
    return V.smoke_results(asked, hits).select("query_id", "result_count", "matched_keywords", "missing_traceability", "passed")

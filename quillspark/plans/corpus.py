"""Queries over the corpus as a registry: decisions by terms, merging, combination, identifiers, text statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import text as T
from quillspark.functions.sentences import split_sentences, split_sentences_sql
from quillspark.operators import classify as C
from quillspark.operators import registry as R
from quillspark.plans import query, table
from quillspark.storage import with_row_number

_R = C.FIXTURE


def norm_sql(x: str) -> str:
    return f"trim(regexp_replace(translate(lower({x}), '‐‑–—', '----'), '\\s+', ' ', 'g'))"


def decided_sql(source: str, text: str) -> str:
    """CTEs n, m, s and d: ``source`` with decision, include_score, exclude_score, include_matches, exclude_matches, review_reason."""
    total = "coalesce(list_sum(list_transform({}, lambda z: z.weight)), 0)::INTEGER"
    strong = ", ".join(f"'{t}'" for t in sorted(_R.strong))
    heavy = ", ".join(f"'{t}'" for t in sorted(_R.heavy))
    return f"""n AS (SELECT *, {norm_sql(text)} AS tt FROM {source}),
m AS (SELECT *, {_R.disease.sql('tt')} AS dm, {_R.treatment.sql('tt')} AS tm, {_R.human.sql('tt')} AS hm, {_R.exclude.sql('tt')} AS xm FROM n),
s AS (SELECT *, {total.format('tm')} AS t, {total.format('hm')} AS h, {total.format('xm')} AS x,
  {total.format('dm')} + {total.format('tm')} + {total.format('hm')} AS i,
  len(list_filter(dm, lambda z: z.term IN ({strong}))) > 0 AS strong, len(list_filter(xm, lambda z: z.term IN ({heavy}))) > 0 AS heavy FROM m),
d AS (SELECT *, {C.chain_sql(C._EN_CHAIN, 1)} AS decision, {C.chain_sql(C._EN_CHAIN, 2)} AS review_reason, i AS include_score, x AS exclude_score,
  list_transform(list_concat(dm, list_concat(tm, hm)), lambda z: z.term) AS include_matches, list_transform(xm, lambda z: z.term) AS exclude_matches FROM s)"""


def _decided(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.classify(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), F.col("text"), _R).drop("text")


@query(f"WITH {decided_sql('documents', 'text')} SELECT decision, review_reason, count(*) AS n FROM d GROUP BY ALL")
def q01_term_class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.bucket_counts(_decided(spark, sf_dir).select("decision.decision", "decision.review_reason"), "decision", "review_reason")


@query(
    f"WITH {decided_sql('documents', 'text')} SELECT doc_id, decision AS filter_decision, include_score AS filter_include_score, exclude_score AS filter_exclude_score, "
    "array_to_string(include_matches, '; ') AS filter_include_matches, array_to_string(exclude_matches, '; ') AS filter_exclude_matches, review_reason AS filter_review_reason FROM d"
)
def q02_doc_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decided(spark, sf_dir).select("doc_id", *C.decision_columns())


#: The documents as records of several sources with keys of all three kinds.
_RECORDS = """SELECT doc_id AS seq, source AS source_name, CAST(substr(source, 4, 9) AS INTEGER) AS source_rank,
  CASE WHEN doc_id % 3 = 0 THEN substr(md5(text), 1, 10) ELSE '' END AS pmid, CASE WHEN doc_id % 5 = 0 THEN concat('pmc', doc_id) ELSE '' END AS pmcid,
  CASE WHEN doc_id % 4 = 0 THEN concat('10.1/', upper(substr(md5(text), 1, 8))) ELSE '' END AS doi, text AS title,
  text AS abstract, source AS journal, CASE WHEN doc_id % 7 = 0 THEN '' ELSE lang END AS year FROM documents"""
_COLUMNS = R.FIELDS[:7]
_TITLE_SQL = "trim(regexp_replace(lower(title), '\\s+', ' ', 'g'))"
_MERGED_SQL = f"""WITH r AS ({_RECORDS}),
k AS (SELECT *, CASE WHEN pmid <> '' THEN concat('pmid:', pmid) WHEN doi <> '' THEN concat('doi:', lower(doi)) ELSE concat('title:', {_TITLE_SQL}) END AS dedupe_key FROM r),
g AS (SELECT dedupe_key, {', '.join(f"coalesce(arg_min({c}, seq) FILTER (WHERE trim({c}) <> ''), '') AS {c}" for c in _COLUMNS)}, min(seq) AS first_seq FROM k GROUP BY dedupe_key),
o AS (SELECT dedupe_key, string_agg(source_name, ';' ORDER BY source_rank) AS source_queries, CAST(count(*) AS VARCHAR) AS source_query_count
  FROM (SELECT DISTINCT dedupe_key, source_name, source_rank FROM k) GROUP BY dedupe_key),
merged AS (SELECT g.*, o.source_queries, o.source_query_count FROM g JOIN o USING (dedupe_key))"""


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = spark.sql(_RECORDS.replace("FROM documents", "FROM {docs}"), docs=table(spark, sf_dir, "documents"))
    return R.merge(records, fields=_COLUMNS)


@query(f"{_MERGED_SQL} SELECT * FROM merged")
def q03_registry_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir)


@query(f"""{_MERGED_SQL} SELECT 'total' AS measure, count(*) AS n FROM merged UNION ALL SELECT 'with_pmcid', count(*) FROM merged WHERE pmcid <> ''
UNION ALL SELECT 'with_doi', count(*) FROM merged WHERE doi <> '' UNION ALL SELECT 'multi_source', count(*) FROM merged WHERE CAST(source_query_count AS INTEGER) > 1
UNION ALL SELECT concat('source:', s), count(*) FROM (SELECT unnest(string_split(source_queries, ';')) AS s FROM merged) GROUP BY s""")
def q04_registry_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.summary(_merged(spark, sf_dir))


_PARTS = {
    "documents": "SELECT doc_id AS seq, CASE WHEN doc_id % 50 = 0 THEN '' ELSE md5(text) END AS chunk_id, CASE WHEN doc_id % 3 = 0 THEN '' ELSE source END AS source_type, text FROM documents",
    "benchmark": "SELECT item_id AS seq, md5(text) AS chunk_id, 'benchmark' AS source_type, text FROM benchmark",
}


@query(f"""WITH a AS (SELECT 0 AS part, * FROM ({_PARTS['documents']}) UNION ALL SELECT 1, * FROM ({_PARTS['benchmark']})),
b AS (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY part, seq) AS n FROM a)
SELECT seq, chunk_id, CASE WHEN source_type = '' THEN 'pmc_full_text' ELSE source_type END AS source_type, text, part FROM b WHERE n = 1 OR chunk_id = ''""")
def q05_combine_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.combine([spark.sql(sql.replace(f"FROM {t}", "FROM {t}"), t=table(spark, sf_dir, t)) for t, sql in _PARTS.items()])


@query("SELECT * FROM (SELECT conv_id, turn, role, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS INTEGER) AS occurrence FROM conversations) WHERE occurrence > 1")
def q06_duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.repeated_ids(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role"), "conv_id", ["turn"])


@query("""SELECT row_number() OVER (ORDER BY doc_id) - 1 AS row_index, concat('D', doc_id) AS chunk_id, lang AS language, 'unknown' AS source_type, source AS journal,
  CAST(length(text) AS INTEGER) AS char_count, text FROM documents""")
def q07_row_index_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    chunks = docs.select("doc_id", F.concat(F.lit("D"), "doc_id").alias("chunk_id"), F.col("lang").alias("language"), F.col("source").alias("journal"), F.length("text").alias("char_count"), "text")
    return R.metadata(with_row_number(chunks, ["doc_id"])).select("row_index", "chunk_id", "language", "source_type", "journal", "char_count", "text")


_FOLD_SQL = "trim(regexp_replace({}, '\\s+', ' ', 'g'))"


@query(f"""SELECT doc_id, concat_ws(chr(10), CASE WHEN lang <> 'en' THEN concat('Title: ', lang) END,
  concat('Section: ', source), concat('Text: ', {_FOLD_SQL.format('text')})) AS embedding_text FROM documents""")
def q08_embedding_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", R.embedding_text(F.nullif("lang", F.lit("en")), "source", "text").alias("embedding_text"))


@query("""SELECT page_id, coalesce(nullif(substr(regexp_replace(regexp_replace(url, '[^A-Za-z0-9._-]+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 80), ''), 'section') AS slug,
  coalesce(nullif(substr(regexp_replace(regexp_replace(url, '[^A-Za-z0-9一-鿿]+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 60), ''), 'rag_query') AS query_slug,
  concat('PMC', page_id) AS article_key, concat('CNKI-', upper(substr(sha1(url), 1, 12))) AS document_key, concat('SEC-', upper(substr(sha1(url), 1, 8))) AS section_key FROM pages""")
def q09_id_normalisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", T.slug("url", "section").alias("slug"), T.query_slug("url").alias("query_slug"), T.article_key(F.col("page_id").cast("string")).alias("article_key"), T.document_key("url").alias("document_key"), T.section_key("url").alias("section_key"))


@query("""SELECT *, content_chars >= 60 AND cjk_chars >= 20 AND private_chars <= 24 AND private_chars / greatest(visible_chars, 1) <= 0.015 AS usable FROM (
  SELECT doc_id, CAST(len(regexp_extract_all(text, '[A-Za-z0-9㐀-䶿一-鿿]')) AS INTEGER) AS content_chars, CAST(len(regexp_extract_all(text, '[㐀-䶿一-鿿]')) AS INTEGER) AS cjk_chars,
  0::INTEGER AS private_chars, CAST(length(regexp_replace(text, '\\s+', '', 'g')) AS INTEGER) AS visible_chars FROM documents)""")
def q10_char_class_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id", T.content_chars("text").alias("content_chars"), T.cjk_chars("text").alias("cjk_chars"), T.private_use_chars("text").alias("private_chars"), T.visible_chars("text").alias("visible_chars"), T.text_is_usable("text").alias("usable")
    )


@query(f"""SELECT doc_id, CAST(k AS INTEGER) AS sentence_index, s[k] AS sentence FROM (SELECT doc_id, {split_sentences_sql('text')} AS s FROM documents), unnest(range(1, len(s) + 1)) AS u(k)""")
def q11_sentence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.posexplode(split_sentences("text")).alias("k", "sentence")).select("doc_id", (F.col("k") + 1).alias("sentence_index"), "sentence")


_WORD_SQL = "[A-Za-z0-9]+(?:[-''][A-Za-z0-9]+)?"


@query(f"""SELECT doc_id, CAST(len(regexp_extract_all(text, '{_WORD_SQL}|[一-鿿]')) AS INTEGER) AS words, CAST(len(regexp_extract_all(text, '[㐀-䶿一-鿿]|{_WORD_SQL}')) AS INTEGER) AS units FROM documents""")
def q12_word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.word_count("text").alias("words"), T.unit_count("text").alias("units"))


@query(f"""WITH {decided_sql('documents', 'text')} SELECT doc_id, lang AS year, decision AS filter_decision, CAST(include_score AS VARCHAR) AS filter_include_score,
  array_to_string(include_matches, '; ') AS filter_include_matches, substr({_FOLD_SQL.format('text')}, 1, 500) AS abstract_excerpt FROM d""")
def q40_view_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.classify(table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("year"), F.col("text").alias("abstract")), F.col("abstract"), _R)
    flat = docs.select("doc_id", "year", "abstract", *C.decision_columns())
    return R.view(flat, ("doc_id", "year", "filter_decision", "filter_include_score", "filter_include_matches")).withColumn("doc_id", F.col("doc_id").cast("bigint"))

"""Queries over sentences and chunks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.functions.sentences import split_sentences, split_sentences_sql
from quillspark.functions.text import let, word_count
from quillspark.functions.vectors import dot
from quillspark.operators import chunking as K
from quillspark.plans import query, table

_WORD_SQL = "[A-Za-z0-9]+(?:[-''][A-Za-z0-9]+)?|[一-鿿]"


@query("""WITH s AS (SELECT conv_id, list(text ORDER BY turn) AS s FROM conversations GROUP BY conv_id)
SELECT conv_id, CAST(g AS INTEGER) AS gap, array_to_string(s[greatest(g - 1, 1):g], ' ') AS before, array_to_string(s[g + 1:g + 2], ' ') AS after
FROM s, unnest(range(1, len(s))) AS u(g)""")
def q13_gap_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda t: t["text"]).alias("s"))
    return turns.select("conv_id", F.posexplode(K.windows_of("s")).alias("k", "w")).select("conv_id", (F.col("k") + 1).alias("gap"), F.col("w.left").alias("before"), F.col("w.right").alias("after"))


#: Scores of neighbours within a label, a stand-in for the similarity of sentence windows.
_LIMITS = K.Limits(max_sentences=9, percentile=35.0)
_SIMS_SQL = """v AS (SELECT label, vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
p AS (SELECT label, vec_id, list_inner_product(e, lead(e) OVER (PARTITION BY label ORDER BY vec_id)) AS sim FROM v),
g AS (SELECT label, list(round(sim, 6) ORDER BY vec_id) AS sims FROM p WHERE sim IS NOT NULL GROUP BY label)"""


def _similarities(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = W.partitionBy("label").orderBy("vec_id")
    pairs = table(spark, sf_dir, "embeddings").select("label", "vec_id", "embedding", F.lead("embedding").over(w).alias("after")).where("after is not null")
    scored = pairs.select("label", "vec_id", F.round(dot("embedding", "after"), 6).alias("sim"))
    return scored.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("vec_id", "sim"))), lambda x: x["sim"]).alias("sims"))


@query(f"""WITH {_SIMS_SQL} SELECT label, CAST(i AS INTEGER) AS gap, sims[i] AS score, round(quantile, 6) AS threshold,
  (i = 1 OR sims[i] <= sims[i - 1] - 0.02) AND (i = len(sims) OR sims[i] <= sims[i + 1] - 0.02) AS valley
FROM (SELECT *, list_aggregate(sims, 'quantile_cont', 0.35) AS quantile FROM g), unnest(range(1, len(sims) + 1)) AS u(i)""")
def q14_local_valleys(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _similarities(spark, sf_dir).withColumn("threshold", F.round(K.percentile("sims", 35), 6))
    each = scored.select("label", "sims", "threshold", F.posexplode("sims").alias("k", "score"))
    return each.select("label", (F.col("k") + 1).alias("gap"), "score", "threshold", K.is_valley(F.col("sims"), F.col("k"), 0.02).alias("valley"))


@query(f"""WITH {_SIMS_SQL}, q AS (SELECT *, list_aggregate(sims, 'quantile_cont', 0.35) AS lim, len(sims) AS n FROM g)
SELECT label, list_transform(list_reduce(list_prepend(NULL, range(1, n + 1)), lambda a, i: CASE
  WHEN i - a.st >= 9 OR (i - a.st >= 2 AND n + 1 - i >= 2 AND sims[i] <= lim AND (i = 1 OR sims[i] <= sims[i - 1] - 0.02) AND (i = n OR sims[i] <= sims[i + 1] - 0.02))
  THEN {{'st': i, 'cuts': list_append(a.cuts, i)}} ELSE a END, {{'st': 0::BIGINT, 'cuts': []::BIGINT[]}}).cuts, lambda x: x::INTEGER) AS cuts FROM q""".replace("list_prepend(NULL, range(1, n + 1))", "range(1, n + 1)"))
def q15_semantic_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _similarities(spark, sf_dir).select("label", K.boundaries("sims", _LIMITS).alias("cuts"))


#: Every third gap of a document is a cut; ranges are merged under 30 and split over 90 words.
_SIZES = K.Limits(least=30, most=90)
_SENTENCES_SQL = f"""t AS (SELECT doc_id, {split_sentences_sql('text')} AS s FROM documents),
z AS (SELECT doc_id, list_transform(s, lambda p: len(regexp_extract_all(p, '{_WORD_SQL}'))::BIGINT) AS n FROM t WHERE len(s) > 0),
r AS (SELECT doc_id, n, list_transform(range(0, CAST(ceil(len(n) / 3) AS BIGINT)), lambda k: {{'start': k * 3, 'stop': least(k * 3 + 3, len(n))}}) AS r FROM z)"""
_SUM = "list_sum(n[{0}.start + 1:{0}.stop])"
_MERGE_SQL = f"""merged AS (SELECT doc_id, n, list_reduce(range(2, len(r) + 1), lambda a, k: CASE
  WHEN {_SUM.format('a.p')} < 30 AND list_sum(n[a.p.start + 1:r[k].stop]) <= 90 THEN {{'p': {{'start': a.p.start, 'stop': r[k].stop}}, 'done': a.done}}
  ELSE {{'p': r[k], 'done': list_append(a.done, a.p)}} END, {{'p': r[1], 'done': []::STRUCT(start BIGINT, stop BIGINT)[]}}) AS a FROM r),
m AS (SELECT doc_id, n, list_append(a.done, a.p) AS r FROM merged)"""


def _ranged(spark: SparkSession, sf_dir: str, fold: Callable[[Column, Column], Column]) -> DataFrame:
    """(doc_id, r): the fold of every third gap's ranges and the sentences' sizes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.transform(split_sentences("text"), word_count).alias("n")).where(F.size("n") > 0)
    docs = docs.withColumn("r", K.ranges(F.size("n"), F.transform(F.sequence(F.lit(1), F.size("n")), lambda k: k * 3)))
    return docs.select("doc_id", fold(F.col("r"), F.col("n")).alias("r"))


def _exploded(df: DataFrame) -> DataFrame:
    return df.select("doc_id", F.posexplode("r").alias("k", "x")).select("doc_id", (F.col("k") + 1).alias("chunk_index"), F.col("x.start").alias("start"), F.col("x.stop").alias("stop"))


_EXPLODE_SQL = "SELECT doc_id, CAST(k AS INTEGER) AS chunk_index, CAST(r[k].start AS INTEGER) AS start, CAST(r[k].stop AS INTEGER) AS stop FROM {}, unnest(range(1, len(r) + 1)) AS u(k)"


@query(f"WITH {_SENTENCES_SQL}, {_MERGE_SQL} {_EXPLODE_SQL.format('m')}")
def q16_merge_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exploded(_ranged(spark, sf_dir, lambda r, n: K.merge_short(r, n, _SIZES)))


_SPLIT_SQL = f"""each AS (SELECT doc_id, n, r[j] AS x FROM m, unnest(range(1, len(r) + 1)) AS u(j)),
folded AS (SELECT doc_id, x, list_reduce(range(x.start, x.stop), lambda a, i: CASE WHEN i - a.st + 1 > 2 AND a.w + n[i + 1] > 90
  THEN {{'st': i, 'w': n[i + 1], 'done': list_append(a.done, {{'start': a.st, 'stop': i}})}} ELSE {{'st': a.st, 'w': a.w + n[i + 1], 'done': a.done}} END,
  {{'st': x.start, 'w': 0::BIGINT, 'done': []::STRUCT(start BIGINT, stop BIGINT)[]}}) AS a, {_SUM.format('x')} > 90 AS big FROM each),
parts AS (SELECT doc_id, unnest(CASE WHEN big THEN list_append(a.done, {{'start': a.st, 'stop': x.stop}}) ELSE [x] END) AS p FROM folded)"""


@query(f"""WITH {_SENTENCES_SQL}, {_MERGE_SQL}, {_SPLIT_SQL}
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY p.start) AS INTEGER) AS chunk_index, CAST(p.start AS INTEGER) AS start, CAST(p.stop AS INTEGER) AS stop FROM parts""")
def q17_split_oversized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exploded(_ranged(spark, sf_dir, lambda r, n: K.split_oversized(K.merge_short(r, n, _SIZES), n, _SIZES)))


@query(f"""WITH t AS (SELECT doc_id, {split_sentences_sql('text')} AS s0, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS folded FROM documents),
b AS (SELECT doc_id, CASE WHEN len(s0) > 0 THEN s0 ELSE [folded] END AS s FROM t WHERE folded <> ''),
z AS (SELECT doc_id, s, list_transform(s, lambda p: len(regexp_extract_all(p, '{_WORD_SQL}'))::BIGINT) AS n FROM b),
f AS (SELECT doc_id, s, list_reduce(range(1, len(n) + 1), lambda a, i: CASE WHEN i - 1 > a.st AND a.w + n[i] > 260
  THEN {{'st': i - 1, 'w': n[i], 'done': list_append(a.done, {{'start': a.st, 'stop': i - 1}})}} ELSE {{'st': a.st, 'w': a.w + n[i], 'done': a.done}} END,
  {{'st': 0::BIGINT, 'w': 0::BIGINT, 'done': []::STRUCT(start BIGINT, stop BIGINT)[]}}) AS a FROM z),
r AS (SELECT doc_id, s, list_append(a.done, {{'start': a.st, 'stop': len(s)}}) AS r FROM f),
c AS (SELECT concat('PMID', doc_id, '::Abstract::', lpad(k::VARCHAR, greatest(length(k::VARCHAR), 3)::INTEGER, '0')) AS chunk_id, r[k].start AS st, r[k].stop AS en,
  trim(array_to_string(s[r[k].start + 1:r[k].stop], ' ')) AS text FROM r, unnest(range(1, len(r) + 1)) AS u(k))
SELECT chunk_id, CAST(st + 1 AS INTEGER) AS sentence_start, CAST(en AS INTEGER) AS sentence_end, CAST(en - st AS INTEGER) AS sentence_count,
  CAST(len(regexp_extract_all(text, '{_WORD_SQL}')) AS INTEGER) AS word_count, CAST(length(text) AS INTEGER) AS char_count, text FROM c""")
def q18_pack_abstract(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("pmid"), F.lit("").alias("title"), F.col("text").alias("abstract"))
    return K.abstract_chunks(docs).select("chunk_id", "sentence_start", "sentence_end", "sentence_count", "word_count", "char_count", "text")

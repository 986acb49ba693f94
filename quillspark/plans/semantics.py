"""Queries that join chunks with articles and score them against anchors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions.terms import TermSet
from quillspark.operators import classify as C
from quillspark.operators import semantic as S
from quillspark.plans import query, table
from quillspark.plans.corpus import decided_sql, norm_sql
from quillspark.functions.sentences import split_sentences_sql

_R = C.FIXTURE
#: Documents are articles with up to three identifiers; conversation turns are chunks that name some of them.
_ARTICLES = "SELECT doc_id AS seq, CASE WHEN doc_id % 3 = 0 THEN '' ELSE concat('pmc', doc_id % 400) END AS pmcid, CASE WHEN doc_id % 4 = 0 THEN '' ELSE concat('', doc_id % 300) END AS pmid, CASE WHEN doc_id % 5 = 0 THEN concat('10.1/', doc_id) ELSE '' END AS doi, text FROM documents"
_CHUNKS = "SELECT conv_id, turn, CASE WHEN (conv_id + turn) % 3 = 1 THEN '' ELSE concat('PMC', (conv_id * 7 + turn) % 500) END AS pmcid, CASE WHEN turn % 2 = 0 THEN '' ELSE concat('', (conv_id * 5 + turn) % 400) END AS pmid, concat('10.1/', conv_id * 5) AS doi, role AS section, text FROM conversations"


def _view(spark: SparkSession, sf_dir: str, sql: str, name: str) -> DataFrame:
    return spark.sql(sql.replace(f"FROM {name}", "FROM {t}"), t=table(spark, sf_dir, name))


_IDS_SQL = f"[{{'prio': 0, 'id': {norm_sql('pmcid')}}}, {{'prio': 1, 'id': {norm_sql('pmid')}}}, {{'prio': 2, 'id': {norm_sql('doi')}}}]"
_NOISE = ", ".join(f"'{t}'" for t in sorted(_R.noise))


def _rename(ctes: str, prefix: str) -> str:
    """The CTEs of :func:`decided_sql` under names of their own."""
    for k in "nmsd":
        ctes = ctes.replace(f"{k} AS (SELECT", f"{prefix}{k} AS (SELECT").replace(f" FROM {k})", f" FROM {prefix}{k})").replace(f" FROM {k}", f" FROM {prefix}{k}") if k != "d" else ctes.replace("d AS (SELECT *, CASE", f"{prefix}d AS (SELECT *, CASE")
    return ctes


_MATRIX_SQL = f"""WITH articles AS ({_ARTICLES}), chunks AS ({_CHUNKS}),
{_rename(decided_sql('articles', 'text'), 'ar_')},
{_rename(decided_sql('chunks', "concat(section, ' ', text)"), 'ch_')},
byid AS (SELECT x.id AS id, arg_max(decision, seq) AS decision FROM (SELECT seq, decision, unnest({_IDS_SQL}) AS x FROM ar_d) WHERE x.id <> '' GROUP BY x.id),
found AS (SELECT conv_id, turn, arg_min(byid.decision, x.prio) AS article FROM (SELECT conv_id, turn, unnest({_IDS_SQL}) AS x FROM ch_d) k JOIN byid ON byid.id = k.x.id GROUP BY ALL),
j AS (SELECT ch_d.*, article, len(list_filter(exclude_matches, lambda z: z IN ({_NOISE}))) > 0 AS noisy FROM ch_d LEFT JOIN found USING (conv_id, turn))"""


@query(f"""{_MATRIX_SQL}
SELECT conv_id, turn, CASE WHEN article = 'exclude' THEN 'article' WHEN article = 'include' AND noisy THEN 'chunk_noise_review' WHEN article = 'include' AND decision = 'include' THEN 'article_and_chunk'
  WHEN decision = 'include' AND article IS DISTINCT FROM 'include' THEN 'chunk_without_included_article' ELSE 'chunk' END AS filter_level,
CASE WHEN article = 'exclude' THEN 'excluded' WHEN article = 'include' AND NOT noisy AND decision = 'include' THEN 'strict' WHEN article = 'include' OR decision <> 'exclude' THEN 'review' ELSE 'excluded' END AS bucket,
CASE WHEN article = 'exclude' THEN 'exclude' ELSE decision END AS shown FROM j""")
def q21_article_chunk_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    articles = C.classify(_view(spark, sf_dir, _ARTICLES, "documents"), F.col("text"), _R).select("seq", "pmcid", "pmid", "doi", "decision")
    chunks = C.classify_chunks(_view(spark, sf_dir, _CHUNKS, "conversations"), _R).drop("text")
    routed = C.route_chunks(C.with_article(chunks, C.decisions_by_id(articles, "seq"), ["conv_id", "turn"]), _R)
    return routed.select("conv_id", "turn", "filter_level", "bucket", F.col("shown.decision").alias("shown"))


@query(f"""{_MATRIX_SQL.replace(' JOIN byid ON byid.id = k.x.id', ' JOIN byid ON byid.id = k.x.id AND k.x.prio = 0')}
SELECT conv_id, turn, CASE WHEN article IS NULL THEN 'missing_registry' WHEN article = 'exclude' THEN 'article' WHEN article = 'review' THEN 'article_review' ELSE 'article' END AS filter_level,
CASE WHEN article IS NULL OR article = 'review' THEN 'review' WHEN article = 'exclude' THEN 'excluded' ELSE 'strict' END AS bucket FROM j""")
def q22_document_chunk_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matrix for chunks that name one document; no row here speaks of animals in Chinese."""
    articles = C.classify(_view(spark, sf_dir, _ARTICLES, "documents"), F.col("text"), _R).select("seq", "pmcid", "pmid", "doi", "decision")
    chunks = C.classify_chunks(_view(spark, sf_dir, _CHUNKS, "conversations"), _R).drop("pmid", "doi")
    joined = C.with_article(chunks, C.decisions_by_id(articles, "seq"), ["conv_id", "turn"])
    return C.route_chunks_cjk(joined).select("conv_id", "turn", "filter_level", "bucket")


_OWN_SQL = "[{'prio': 0, 'id': CASE WHEN pmcid <> '' THEN concat('pmcid:', lower(pmcid)) END}, {'prio': 1, 'id': CASE WHEN pmid <> '' THEN concat('pmid:', lower(pmid)) END}, {'prio': 2, 'id': CASE WHEN doi <> '' THEN concat('doi:', lower(doi)) END}]"


@query(f"""WITH r AS (SELECT seq AS record_id, * FROM ({_ARTICLES})), c AS (SELECT conv_id * 1000 + turn AS seq, concat('C', conv_id, '-', turn) AS chunk_id, * FROM ({_CHUNKS})),
rx AS (SELECT record_id, unnest({_OWN_SQL}) AS x FROM r), cx AS (SELECT chunk_id, seq, unnest({_OWN_SQL}) AS x FROM c),
f AS (SELECT record_id, chunk_id, arg_min(rx.x.prio, rx.x.prio * 1000000000 + seq) AS prio FROM rx JOIN cx ON rx.x.id = cx.x.id GROUP BY ALL),
alone AS (SELECT record_id, concat(coalesce(list_filter({_OWN_SQL}, lambda z: z.id IS NOT NULL)[1].id, 'unknown'), '::registry_abstract') AS chunk_id, 0 AS prio FROM r
  WHERE trim(text) <> '' AND record_id NOT IN (SELECT record_id FROM f))
SELECT record_id, chunk_id, CAST(prio AS INTEGER) AS prio FROM f UNION ALL SELECT * FROM alone""")
def q23_multi_key_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _view(spark, sf_dir, _ARTICLES, "documents").select(F.col("seq").alias("record_id"), "pmcid", "pmid", "doi", F.col("text").alias("abstract"), F.lit("").alias("title"))
    chunks = _view(spark, sf_dir, _CHUNKS, "conversations").withColumns({"seq": F.col("conv_id") * 1000 + F.col("turn"), "chunk_id": F.concat(F.lit("C"), "conv_id", F.lit("-"), "turn")})
    return S.chunks_of_records(records, chunks, keep=()).select("record_id", "chunk_id", F.col("place.prio").alias("prio"))


_VECTOR_SQL = "v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings)"


def _score_sql(label: int, name: str) -> str:
    return f"{name} AS (SELECT t.vec_id, list_sum(list_sort(list(list_inner_product(t.e, a.e)), 'DESC')[1:3]) / 3 AS s FROM v t CROSS JOIN v a WHERE a.label = {label} GROUP BY t.vec_id)"


_SCORES_SQL = f"WITH {_VECTOR_SQL}, {_score_sql(0, 'animal')}, {_score_sql(1, 'human')}, sc AS (SELECT v.vec_id, v.label, round(animal.s, 6) AS animal_score, round(human.s, 6) AS human_score FROM v JOIN animal USING (vec_id) JOIN human USING (vec_id))"


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    scored = vectors.select("vec_id", "label", "embedding")
    for label, name in ((0, "animal_score"), (1, "human_score")):
        scored = S.top_mean_similarity(scored, vectors.where(F.col("label") == label), 3, into=name)
    return scored.select("vec_id", "label", F.round("animal_score", 6).alias("animal_score"), F.round("human_score", 6).alias("human_score"))


@query(f"{_SCORES_SQL} SELECT * FROM sc")
def q26_topk_mean_to_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir)


_T = S.Thresholds(animal=0.15, margin=0.0, no_term_animal=0.25, no_term_margin=0.05, ratio=0.4, review_ratio=0.2, single=0.2)
_FLAGS_SQL = f"{_SCORES_SQL}, fl AS (SELECT *, vec_id % 3 = 0 AS lexical, animal_score >= 0.15 AND animal_score - human_score >= 0 AND (vec_id % 3 = 0 OR (animal_score >= 0.25 AND animal_score - human_score >= 0.05)) AS is_animal FROM sc)"


def _flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _scores(spark, sf_dir).withColumn("lexical", F.col("vec_id") % 3 == 0)
    return scored.withColumn("is_animal", S.is_animal("animal_score", "human_score", F.col("lexical"), _T))


@query(f"{_FLAGS_SQL} SELECT vec_id, animal_score, human_score, is_animal FROM fl")
def q27_chunk_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flags(spark, sf_dir).select("vec_id", "animal_score", "human_score", "is_animal")


@query(f"""{_FLAGS_SQL}, st AS (SELECT vec_id % 40 AS article, count(*) AS n, count_if(is_animal) AS hits, count_if(is_animal) / count(*) AS ratio, count_if(lexical) AS lex, max(animal_score) AS top, avg(animal_score) AS mean FROM fl GROUP BY ALL),
d AS (SELECT *, article % 9 = 0 AS named, article % 7 = 0 AND article % 9 <> 0 AS safe, CASE WHEN article % 2 = 0 THEN 'strict' ELSE 'review' END AS status FROM st),
o AS (SELECT *, (named AND hits > 0) OR (n = 1 AND hits > 0 AND top >= 0.2 AND (lex > 0 OR named) AND NOT safe) OR (n > 1 AND ratio > 0.4 AND hits >= 2 AND lex >= 2 AND NOT safe) AS gone,
  hits > 0 AND (ratio >= 0.2 OR named) AND (lex > 0 OR named) AND NOT safe AND status = 'strict' AS doubt FROM d)
SELECT article, n AS chunk_count, CAST(hits AS BIGINT) AS animal_hits, round(ratio, 6) AS animal_ratio, round(top, 6) AS max_animal_score, round(mean, 6) AS mean_animal_score,
  CASE WHEN gone THEN 'exclude_animal' WHEN doubt THEN 'review_animal' ELSE 'keep' END AS semantic_decision, CASE WHEN gone THEN 'excluded' WHEN doubt THEN 'review' ELSE status END AS semantic_final_status FROM o""")
def q28_article_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = S.article_stats(_flags(spark, sf_dir).withColumn("article", F.col("vec_id") % 40), ["article"])
    some, none = F.array(F.lit("cow")), F.array().cast("array<string>")
    named = stats.withColumns({"title_animal_terms": F.when(F.col("article") % 9 == 0, some).otherwise(none), "title_human_terms": F.when(F.col("article") % 7 == 0, some).otherwise(none), "status": F.when(F.col("article") % 2 == 0, "strict").otherwise("review")})
    return S.audit_order(S.decide_articles(named, _T).withColumn("title", F.lit(""))).select("article", "chunk_count", "animal_hits", "animal_ratio", "max_animal_score", "mean_animal_score", "semantic_decision", "semantic_final_status")


_ANCHOR_TERMS = S.AnchorTerms(animal=TermSet.of(["thnt", "reen", "onre", "anha"]), target=TermSet.of(["that the", "thtion"]), context=TermSet.of(["are", "les"]), condition=TermSet.of(["the"]), treatment=TermSet.of(["from", "thing"]))


@query(f"""WITH s AS (SELECT concat('pmid:', doc_id % 60) AS source_id, concat('D', doc_id) AS chunk_id, doc_id AS seq, k, t[k] AS text FROM (SELECT doc_id, {split_sentences_sql('text')} AS t FROM documents), unnest(range(1, len(t) + 1)) AS u(k)),
w AS (SELECT *, len(regexp_extract_all(text, '[A-Za-z0-9]+(?:[-''][A-Za-z0-9]+)?|[一-鿿]')) AS words, {norm_sql('text')} AS n FROM s),
m AS (SELECT *, {_ANCHOR_TERMS.animal.sql('n')} AS a, len({_ANCHOR_TERMS.condition.sql('n')}) > 0 AS c FROM w WHERE words BETWEEN 12 AND 100),
x AS (SELECT *, len(a) * 4 + least(words // 20, 4) AS score FROM m WHERE c AND len(a) > 0),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY n ORDER BY seq, k) AS r FROM x) WHERE r = 1),
g AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY score DESC, text) AS q FROM f) WHERE q <= 3)
SELECT 'animal' AS label, text, source_id, chunk_id, list_transform(a, lambda z: z.term) AS matched_terms, CAST(score AS INTEGER) AS selection_score FROM g ORDER BY score DESC, source_id, text LIMIT 96""")
def q29_anchor_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("seq"), F.concat(F.lit("D"), "doc_id").alias("chunk_id"), (F.col("doc_id") % 60).cast("string").alias("pmid"), F.lit("").alias("title"), "text")
    return S.anchors(docs, "animal", _ANCHOR_TERMS).select("label", "text", "source_id", "chunk_id", "matched_terms", "selection_score")

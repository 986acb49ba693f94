"""Queries over answers: rules, status roll-up, the judge's gate and output, prompts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.operators import evaluate as E
from quillspark.operators import retrieval as R
from quillspark.plans import query, table

#: Assistant turns as answers; no citations occur in them, so some are added by turn and conversation.
_ANSWERS = """SELECT conv_id, turn, concat(text, CASE WHEN turn % 3 = 1 THEN ' [E1] [E2] [E1]' WHEN turn % 3 = 2 THEN ' [E2]' ELSE '' END, CASE WHEN conv_id % 5 = 0 THEN ' [E9]' ELSE '' END,
  CASE WHEN conv_id % 7 = 0 THEN ' <think>' ELSE '' END, CASE WHEN conv_id % 11 = 0 THEN ' 一定有效' ELSE '' END, CASE WHEN conv_id % 13 = 0 THEN ' 可以换药' ELSE '' END) AS answer FROM conversations WHERE role = 'assistant'"""
_RULES_SQL = f"""WITH a AS ({_ANSWERS}), c AS (SELECT *, list_distinct(regexp_extract_all(answer, '\\[(E[0-9]+)\\]', 1)) AS ids0, regexp_extract_all(answer, '\\[(E[0-9]+)\\]', 1) AS every,
  length(trim(answer)) AS answer_chars FROM a),
b AS (SELECT *, list_sort(ids0) AS ids, contains(answer, '<think>') OR contains(answer, '</think>') AS has_think, list_sort(list_filter(ids0, lambda z: z NOT IN ('E1', 'E2', 'E3'))) AS unknown,
  list_filter(['保证治愈', '一定治愈', '一定有效', '100%有效', '完全有效', '必然有效', '无需医生', '替代医生'], lambda z: contains(answer, z)) AS risk, contains(answer, '可以换药') AS advice FROM c),
i AS (SELECT *, list_filter([CASE WHEN answer_chars < 80 THEN 'short_answer' END, CASE WHEN has_think THEN 'think_leak' END, CASE WHEN len(ids) = 0 THEN 'no_citation' END, CASE WHEN len(ids) = 1 THEN 'low_citation_count' END,
  CASE WHEN len(unknown) > 0 THEN 'unknown_citation' END, CASE WHEN len(risk) > 0 THEN 'risk_terms' END, CASE WHEN advice THEN 'clinical_advice' END], lambda z: z IS NOT NULL) AS codes FROM b),
s AS (SELECT *, CASE WHEN len(list_filter(codes, lambda z: z IN ('think_leak', 'no_citation', 'unknown_citation', 'clinical_advice'))) > 0 THEN 'fail' WHEN len(codes) > 0 THEN 'warning' ELSE 'pass' END AS status FROM i)"""


def _rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = spark.sql(_ANSWERS.replace("FROM conversations", "FROM {t}"), t=table(spark, sf_dir, "conversations"))
    return E.evaluate_rules(answers.withColumn("known_evidence_ids", F.array(F.lit("E1"), F.lit("E2"), F.lit("E3"))))


@query(f"{_RULES_SQL} SELECT conv_id, turn, status, CAST(answer_chars AS INTEGER) AS answer_chars, CAST(len(ids) AS INTEGER) AS citation_count, ids AS citations, unknown AS unknown_citations, has_think, risk AS risk_terms, codes FROM s")
def q33_answer_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _rules(spark, sf_dir)
    return found.select("conv_id", "turn", "status", "answer_chars", "citation_count", F.array_sort("citations").alias("citations"), F.array_sort("unknown_citations").alias("unknown_citations"), "has_think", "risk_terms", F.transform("issues", lambda i: i["code"]).alias("codes"))


@query(f"{_RULES_SQL} SELECT conv_id, CASE max(CASE status WHEN 'fail' THEN 2 WHEN 'warning' THEN 1 ELSE 0 END) WHEN 2 THEN 'fail' WHEN 1 THEN 'warning' ELSE 'pass' END AS status FROM s GROUP BY conv_id")
def q34_status_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.worst_of(_rules(spark, sf_dir), ["conv_id"], "status")


_MODE = "CASE turn % 4 WHEN 0 THEN 'judge' WHEN 1 THEN 'rules' WHEN 2 THEN 'all' ELSE 'auto' END"


@query(f"{_RULES_SQL} SELECT conv_id, turn, {_MODE} AS mode, CASE {_MODE} WHEN 'judge' THEN true WHEN 'rules' THEN false ELSE CASE WHEN conv_id % 2 = 0 THEN status <> 'pass' ELSE {_MODE} = 'all' END END AS judge FROM s")
def q35_judge_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _rules(spark, sf_dir).select("conv_id", "turn", "status", F.expr(_MODE).alias("mode"))
    return found.select("conv_id", "turn", "mode", E.should_judge("status", F.col("mode"), F.col("conv_id") % 2 == 0).alias("judge"))


@query(f"""{_RULES_SQL}, j AS (SELECT *, CASE turn % 4 WHEN 0 THEN 'pass' WHEN 1 THEN 'fail' WHEN 2 THEN 'odd' ELSE 'skipped' END AS judged FROM s)
SELECT conv_id, turn, status, judged, CASE WHEN status = 'fail' OR judged = 'fail' THEN 'fail' WHEN status = 'warning' OR judged = 'odd' THEN 'warning' ELSE 'pass' END AS overall_status FROM j""")
def q36_evaluation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = F.expr("CASE turn % 4 WHEN 0 THEN 'pass' WHEN 1 THEN 'fail' WHEN 2 THEN 'odd' ELSE 'skipped' END")
    return E.report(_rules(spark, sf_dir).withColumn("judged", judged), "all", "judged").select("conv_id", "turn", "status", "judged", "overall_status")


#: Every event's type and properties as a judgement inside a judge's chatter, some without any object, some broken.
_RAW = "CASE event_id % 4 WHEN 0 THEN concat('Result: ', p, ' done') WHEN 1 THEN concat('```json ', p, ' ```') WHEN 2 THEN concat('no object ', substr(p, 2, length(p) - 2)) ELSE concat('{broken ', p) END"
_P = "concat('{\"status\": \"', event_type, '\", ', substr(replace(props, '\"k\"', '\"safety_score\"'), 2))"


@query("""SELECT event_id, CASE WHEN event_id % 4 > 1 THEN 'warning' ELSE event_type END AS status, CAST(CASE WHEN event_id % 4 > 1 THEN '0' ELSE regexp_extract(props, '"k": (-?[0-9]+)', 1) END AS INTEGER) AS safety_score,
  0 AS faithfulness_score, event_id % 4 > 1 AS parse_error FROM events""")
def q37_judge_json_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "events").select("event_id", F.expr(_P).alias("p")).select("event_id", E.parse_judgement(F.expr(_RAW)).alias("j"))
    return raw.select("event_id", "j.status", "j.safety_score", "j.faithfulness_score", "j.parse_error")


@query("""WITH h AS (SELECT source AS query_id, doc_id, lang, text, CAST(row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS INTEGER) AS rank FROM documents),
e AS (SELECT query_id, rank, concat('[E', rank, '] ', lang, ' | ', substr(text, 1, 30), chr(10), 'Score: ', rank, chr(10), 'Chunk: D', doc_id, chr(10), 'Text: ', text) AS b FROM h WHERE rank <= 5)
SELECT query_id, count(*) AS evidence_count, md5(concat('{head}', query_id, chr(10), chr(10), 'Evidence:', chr(10), string_agg(b, chr(10) || chr(10) ORDER BY rank), '{tail}')) AS prompt FROM e GROUP BY query_id""".replace("{head}", R.PROMPT_HEAD).replace("{tail}", R.PROMPT_TAIL))
def q38_evidence_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts over the five longest documents of each source (a top-k report)."""
    docs = table(spark, sf_dir, "documents")
    from pyspark.sql import Window as W

    ranked = docs.withColumn("rank", F.row_number().over(W.partitionBy("source").orderBy(F.desc("n_chars"), "doc_id"))).where("rank <= 5")
    hits = ranked.select(F.col("source").alias("query_id"), "rank", F.col("rank").alias("score"), F.concat(F.lit("D"), "doc_id").alias("chunk_id"), F.lit("").alias("pmcid"), F.col("lang").alias("year"), F.substring("text", 1, 30).alias("title"), F.lit("").alias("section"), "text")
    questions = docs.select(F.col("source").alias("query_id")).distinct().withColumn("question", F.col("query_id"))
    return R.prompts(questions, R.evidence(hits)).select("query_id", "evidence_count", F.md5("prompt").alias("prompt"))

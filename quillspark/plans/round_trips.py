"""Queries that write and read again, that parse files made of the tables' texts, and the second pass as a whole."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import text as T
from quillspark.functions.sentences import within_limits
from quillspark.functions.vectors import unit
from quillspark.operators import assess as A
from quillspark.operators import chunking as K
from quillspark.operators import pages as P
from quillspark.operators import validate as V
from quillspark.plans import query, table
from quillspark.sources import articles, files, sinks
from quillspark.storage import shared_dir


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/quillspark/{name}-{uuid.uuid4().hex}"


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def q64_jsonl_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, at = table(spark, sf_dir, "documents"), _folder(spark, "jsonl")
    sinks.write_jsonl(docs, at)
    return files.read_jsonl(spark, at, docs.schema)


@query("SELECT doc_id::VARCHAR AS doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text, 'a; b' AS tags, '' AS absent FROM documents")
def q65_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, at = table(spark, sf_dir, "documents").select("doc_id", "text", F.array(F.lit("a"), F.lit("b")).alias("tags")), _folder(spark, "csv")
    sinks.write_csv(docs, at, ["doc_id", "text", "tags", "absent"])
    return files.read_csv(spark, at)


@query("SELECT lang AS bucket, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY lang")
def q66_bucket_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = _folder(spark, "buckets")
    sinks.write_buckets(table(spark, sf_dir, "documents").withColumnRenamed("lang", "bucket"), at)
    return spark.read.parquet(at).groupBy("bucket").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


_ESCAPED = "replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
_ARTICLE = f"""concat('<article><front><article-id pub-id-type="pmc">', doc_id, '</article-id><article-id pub-id-type="doi">10.1/', doc_id, '</article-id><article-title>A <i>', lang, '</i> title</article-title><journal-title>', source,
  '</journal-title><pub-date><year>20', lpad(CAST(doc_id % 30 AS STRING), 2, '0'), '</year></pub-date><abstract><p>', {_ESCAPED}, ' [1, 2-4]</p><p>short</p><sec><p>', {_ESCAPED}, '</p></sec></abstract></front>',
  '<body><sec><title>Methods</title><p>tiny</p><p>', {_ESCAPED}, '</p><sec><title>Design</title><p>', {_ESCAPED}, '</p></sec></sec><sec><title>Competing interests</title><p>', {_ESCAPED}, '</p></sec></body>', CASE WHEN doc_id % 10 = 0 THEN '' ELSE '</article>' END)"""


@query("""WITH t AS (SELECT doc_id, lang, source, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text FROM documents WHERE doc_id % 10 <> 0),
s AS (SELECT * FROM (VALUES ('Abstract'), ('Methods'), ('Methods > Design')) AS v(section)) SELECT doc_id::VARCHAR AS pmcid, concat('10.1/', doc_id) AS doi, concat('A ', lang, ' title') AS title, source AS journal,
  concat('20', lpad((doc_id % 30)::VARCHAR, 2, '0')) AS year, section, 1 AS paragraph_index, text, CAST(length(text) AS INTEGER) AS char_count, 'parsed' AS status FROM t, s WHERE length(text) >= 40
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'failed' FROM documents WHERE doc_id % 10 = 0
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'empty' FROM t WHERE length(text) < 40""")
def q67_article_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article files made of every document; every tenth is broken."""
    made = table(spark, sf_dir, "documents").select(F.concat(F.lit("/x/PMC"), "doc_id", F.lit(".xml")).alias("path"), F.encode(F.expr(_ARTICLE), "UTF-8").alias("content"))
    return articles.parse_articles(made, 40).select("pmcid", "doi", "title", "journal", "year", "section", "paragraph_index", "text", "char_count", "status")


_VECTOR = "['a', 'e', 'i']"
_ANIMALS = (
    "bovine|dairy cow|dairy cows|cow|cows|cattle|dairy cattle|dairy farm|dairy farms|bulk tank milk|herd|udder|teat|intramammary|somatic cell count|milk yield|veterinary|goat|goats|sheep|ewe|ewes|camel|camels|"
    "buffalo|buffaloes|porcine|sow|sows|murine mastitis|mouse model|mice|rat model|rats"
)
_ANCHORS = [("animal", "aaae"), ("animal", "aaaaai"), ("animal", "aaeai"), ("human", "eeea"), ("human", "eeeei"), ("human", "eeaei")]


def _unit_sql(x: str) -> str:
    counts = f"[length({x}) - length(replace({x}, 'a', '')), length({x}) - length(replace({x}, 'e', '')), length({x}) - length(replace({x}, 'i', ''))]"
    return f"list_transform({counts}, lambda z: CASE WHEN list_sum(list_transform({counts}, lambda y: y * y)) = 0 THEN 0.0::DOUBLE ELSE z / sqrt(list_sum(list_transform({counts}, lambda y: y * y))::DOUBLE) END)"


def _score_sql(label: str) -> str:
    dots = ", ".join(f"round(list_inner_product(v, {_unit_sql(repr(x))}), 9)" for kind, x in _ANCHORS if kind == label)
    return f"list_sum([{dots}]) / 3"


@query(f"""WITH r AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN '' ELSE (doc_id % 150)::VARCHAR END AS pmid, CASE WHEN doc_id % 2 = 0 THEN 'strict' ELSE 'review' END AS status,
  CASE doc_id % 6 WHEN 0 THEN 'Bovine mastitis' WHEN 1 THEN 'Women with mastitis' ELSE source END AS title, CASE WHEN doc_id % 4 = 0 THEN trim(regexp_replace(text, '\\s+', ' ', 'g')) ELSE '' END AS abstract FROM documents),
own AS (SELECT doc_id, concat('Section: ', role, chr(10), 'Text: ', trim(regexp_replace(c.text, '\\s+', ' ', 'g'))) AS t FROM r JOIN conversations c ON r.pmid = c.conv_id::VARCHAR),
x AS (SELECT * FROM own UNION ALL SELECT doc_id, concat('Title: ', title, chr(10), 'Abstract: ', abstract) FROM r WHERE abstract <> '' AND doc_id NOT IN (SELECT doc_id FROM own)),
v AS (SELECT doc_id, {_unit_sql('t')} AS v, regexp_matches(regexp_replace(lower(t), '\\s+', ' ', 'g'), '(^|[^a-z0-9])({_ANIMALS})s?($|[^a-z0-9])') AS lexical FROM x),
s AS (SELECT doc_id, lexical, {_score_sql('animal')} AS a, {_score_sql('human')} AS h FROM v),
g AS (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE a >= 0.52 AND a - h >= 0.02 AND (lexical OR (a >= 0.62 AND a - h >= 0.06))) AS hits, count(*) FILTER (WHERE lexical) AS lex, max(a) AS top FROM s GROUP BY doc_id),
d AS (SELECT r.*, coalesce(n, 0) AS n, hits, lex, top, hits / n AS ratio, title = 'Bovine mastitis' AS named, title = 'Women with mastitis' AS protected FROM r LEFT JOIN g USING (doc_id)),
o AS (SELECT *, n > 0 AND ((named AND hits > 0) OR (n = 1 AND hits > 0 AND top >= 0.6 AND (lex > 0 OR named) AND NOT protected) OR (n > 1 AND ratio > 0.4 AND hits >= 2 AND lex >= 2 AND NOT protected)) AS gone,
  n > 0 AND hits > 0 AND (ratio >= 0.2 OR named) AND (lex > 0 OR named) AND NOT protected AND status = 'strict' AS suspicious FROM d)
SELECT doc_id, n AS chunk_count, hits AS animal_hits, lex AS lexical_hits, CASE WHEN n = 0 THEN 'not_assessed' WHEN gone THEN 'exclude_animal' WHEN suspicious THEN 'review_animal' ELSE 'keep' END AS semantic_decision,
  CASE WHEN n = 0 THEN status WHEN gone THEN 'excluded' WHEN suspicious THEN 'review' ELSE status END AS semantic_final_status FROM o""")
def q68_second_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records are documents, chunks are turns, and a text's vector is how often it has three letters."""
    k = F.col("doc_id")
    docs = table(spark, sf_dir, "documents")
    title = F.when(k % 6 == 0, "Bovine mastitis").when(k % 6 == 1, "Women with mastitis").otherwise(F.col("source"))
    records = docs.select(
        k.alias("record_id"), k.alias("seq"), F.when(k % 7 == 0, "").otherwise((k % 150).cast("string")).alias("pmid"), F.when(k % 2 == 0, "strict").otherwise("review").alias("status"), title.alias("title"),
        F.when(k % 4 == 0, F.col("text")).otherwise("").alias("abstract"),
    )
    chunks = table(spark, sf_dir, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("chunk_id"), (F.col("conv_id") * 1000 + F.col("turn")).alias("seq"), F.col("conv_id").cast("string").alias("pmid"), F.lit("").alias("title"), F.col("role").alias("section"), F.lit("pmc_full_text").alias("source_type"), "text"
    )
    anchors = spark.createDataFrame(_ANCHORS, "label string, text string")
    done = A.assess_records(records, chunks, anchors, lambda t: unit(F.array(*(F.regexp_count(t, F.lit(c)).cast("double") for c in "aei"))))
    return done.select(k_of("record_id"), F.coalesce("chunk_count", F.lit(0)).alias("chunk_count"), "animal_hits", "lexical_hits", "semantic_decision", "semantic_final_status")


def k_of(column: str):
    return F.col(column).alias("doc_id")


@query("SELECT doc_id, source, 'strict' AS status FROM documents WHERE doc_id % 3 = 0 UNION ALL SELECT doc_id, source, 'review' FROM documents WHERE doc_id % 3 = 1")
def q69_with_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return A.with_status(strict=docs.where("doc_id % 3 = 0"), review=docs.where("doc_id % 3 = 1"))


@query("SELECT doc_id, source FROM documents WHERE contains(source, '1') ORDER BY lower(source), doc_id LIMIT 25")
def q70_selected_first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a trial run asks for: rows with a text in their source, the first 25 in order (the limit is the operator)."""
    docs = A.selected(table(spark, sf_dir, "documents").select("doc_id", "source"), "1", "source")
    return A.first_rows(docs, 25, [F.lower("source"), "doc_id"])


@query("SELECT doc_id, CAST(row_number() OVER (ORDER BY lower(concat(CASE WHEN doc_id % 2 = 0 THEN 'Doc' ELSE 'dOC' END, doc_id, '.pdf'))) AS INTEGER) AS place FROM documents")
def q71_casefolded_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("/x/"), F.when(F.col("doc_id") % 2 == 0, "Doc").otherwise("dOC"), "doc_id", F.lit(".pdf")).alias("path"))
    from quillspark.storage import with_row_number

    ordered = A.by_name(names).select("doc_id", F.lower("path").alias("name"))
    return with_row_number(ordered, ["name"], "place", 1).select("doc_id", F.col("place").cast("int").alias("place"))


@query("""SELECT CASE WHEN doc_id % 9 = 0 THEN 1 ELSE 0 END AS failed, count(*) AS n, CAST(sum(CASE WHEN doc_id % 9 = 0 THEN 0 ELSE n_chars % 7 END) AS BIGINT) AS page_count FROM documents GROUP BY 1 HAVING failed = 0""")
def q72_registry_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as parsed files, every ninth failed; failed ones have no registry record."""
    docs = table(spark, sf_dir, "documents")
    totals = docs.select(
        F.concat(F.lit("D"), "doc_id").alias("document_id"), F.col("source").alias("title"), F.lit("p").alias("source_path"), (F.col("n_chars") % 7).alias("page_count"), F.lit(0).alias("native_pages"), F.lit(0).alias("ocr_pages"), F.lit(0).alias("low_text_pages"),
        F.when(F.col("doc_id") % 9 == 0, "failed: x").otherwise("parsed").alias("status"),
    )
    return A.registry_record(totals).agg(F.lit(0).alias("failed"), F.count("*").alias("n"), F.sum("page_count").alias("page_count"))


@query("""SELECT doc_id, round(CASE WHEN doc_id % 5 = 0 THEN 0 ELSE 24 / sqrt(((doc_id % 5) * (doc_id % 5) + 9) * 25::DOUBLE) * (3 * (doc_id % 5) + 12) / 24 END, 9) AS score FROM documents""")
def q73_gap_similarities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cosine of (k, 3) and (3, 4), k from the row; 0 for a zero vector."""
    k = (F.col("doc_id") % 5).cast("double")
    left = F.when(k == 0, F.array(F.lit(0.0), F.lit(0.0))).otherwise(F.array(k, F.lit(3.0)))
    found = table(spark, sf_dir, "documents").select("doc_id", K.gap_similarities(F.array(left), F.array(F.array(F.lit(3.0), F.lit(4.0)))).alias("s"))
    return found.select("doc_id", F.round(F.get("s", F.lit(0)), 9).alias("score"))


@query("""SELECT doc_id, 3 AS pieces, 2 * 1800 + 100 + doc_id % 50 AS chars, 1800 AS longest FROM documents""")
def q74_long_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sentence of 3700 letters and more without a break is cut where it fits."""
    long = F.array(F.repeat(F.lit("x"), (F.lit(3700) + F.col("doc_id") % 50).cast("int")))
    cut = table(spark, sf_dir, "documents").select("doc_id", long.alias("s")).select("doc_id", within_limits("s").alias("s"))
    sizes = F.transform("s", lambda x: F.length(x))
    return cut.select("doc_id", F.size("s").alias("pieces"), F.aggregate(sizes, F.lit(0), lambda a, x: a + x).cast("bigint").alias("chars"), F.array_max(sizes).alias("longest"))


_PAGES = """SELECT source, doc_id, CASE doc_id % 3 WHEN 0 THEN concat('一、结果', chr(10), '甲', doc_id, '句子完整。', chr(10), '乙句也完整。') WHEN 1 THEN concat('丙', doc_id, '句子完整。', chr(10), '参考文献', chr(10), '不要这一行文字。') ELSE concat('讨论', chr(10), '丁', doc_id, '句子完整。') END AS text"""


@query("""WITH p AS (SELECT source, doc_id, doc_id % 3 AS k, last_value(CASE doc_id % 3 WHEN 0 THEN '结果' WHEN 1 THEN '参考文献' ELSE '讨论' END) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS above FROM documents),
s AS (SELECT source, doc_id, 1 AS n, '结果' AS section, concat('甲', doc_id, '句子完整。') AS sentence FROM p WHERE k = 0 UNION ALL SELECT source, doc_id, 2, '结果', '乙句也完整。' FROM p WHERE k = 0
  UNION ALL SELECT source, doc_id, 1, coalesce(above, '正文'), concat('丙', doc_id, '句子完整。') FROM p WHERE k = 1 AND coalesce(above, '') <> '参考文献' UNION ALL SELECT source, doc_id, 1, '讨论', concat('丁', doc_id, '句子完整。') FROM p WHERE k = 2)
SELECT source, section, CAST(row_number() OVER (PARTITION BY source, section ORDER BY doc_id, n) - 1 AS INTEGER) AS k, doc_id AS page_number, sentence FROM s""")
def q75_zh_page_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of a source as pages with headings: sections hold across pages, references are left out, sections that return go on."""
    pages = spark.sql(f"{_PAGES.replace('chr(10)', 'chr(10)')} FROM {{t}}", t=table(spark, sf_dir, "documents")).withColumns({"title": F.lit("题名"), "extraction_method": F.lit("native_text")})
    each = P.sections(pages, document="source", page="doc_id").select("source", "section", F.posexplode("sentences").alias("k", "s"))
    return each.select("source", "section", "k", F.col("s.page_number").alias("page_number"), F.col("s.text").alias("sentence"))


@query("""SELECT 'a_chunk_count_mismatch' AS issue, '{"expected": ' || count(*) || ', "actual": 7}' AS detail FROM documents UNION ALL SELECT 'b_dimension_mismatch', '{"expected": 64, "actual": null}'""")
def q76_manifest_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "documents").count()
    found = V.manifest_issues({"a": {"chunk_count": 7, "embedding_dim": 64}, "b": {"chunk_count": n}}, n, 64)
    return spark.createDataFrame([(x["issue"], x["detail"]) for x in found], "issue string, detail string")


@query("SELECT doc_id, doc_id % 2 = 0 AS article FROM documents")
def q77_looks_like_article(spark: SparkSession, sf_dir: str) -> DataFrame:
    head = F.when(F.col("doc_id") % 2 == 0, F.when(F.col("doc_id") % 4 == 0, "<?xml?><ARTICLE x='1'>").otherwise("<pmc-articleset>")).otherwise("<html><p>")
    return table(spark, sf_dir, "documents").select("doc_id", T.looks_like_article(F.encode(F.concat(head, "text"), "UTF-8")).alias("article"))

"""Queries of the Chinese path. The tables hold no Chinese, so syllables of their invented prose stand for terms and signs, in whole texts.

SQL here is written for itself: terms, weights and rules are spelt out and share nothing with the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import sentences as ST
from quillspark.functions import text as T
from quillspark.operators import chunking as K
from quillspark.operators import classify as C
from quillspark.operators import pages as P
from quillspark.plans import query, table

_SIGNS = [("thtion", "肉芽肿性乳腺炎"), ("elle la", "浆细胞性乳腺炎"), ("attion", "非哺乳期 乳腺炎"), ("onbleing", "乳腺炎"), ("eron", "治疗"), ("thing", "利福平"), ("from", "随访"), ("nicht", "患者"), ("thst", "临床"), ("anha", "乳腺癌")]
_SIGNS += [("thnt", "奶牛"), ("eau", "母乳喂养"), ("der", "病例"), ("ing", "例"), (". ", "。"), (", ", "，"), ("er", "的"), ("on", "了"), ("th", "在"), ("en", "是 "), ("re", "—")]


def _signed(x: str) -> str:
    """SQL of both engines: x with its syllables replaced."""
    for a, b in _SIGNS:
        x = f"replace({x}, '{a}', '{b}')"
    return x


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "source", F.expr(_signed("text")).alias("text"))


_D = f"d AS (SELECT doc_id, source, {_signed('text')} AS text FROM documents)"
_TERMS = """terms AS (SELECT * FROM (VALUES ('d', 0, '非哺乳期乳腺炎', 10), ('d', 1, '非哺乳期乳腺炎症', 10), ('d', 2, '非产褥期乳腺炎', 10), ('d', 3, '肉芽肿性小叶性乳腺炎', 10), ('d', 4, '特发性肉芽肿性乳腺炎', 10),
  ('d', 5, '肉芽肿性乳腺炎', 9), ('d', 6, '浆细胞性乳腺炎', 9), ('d', 7, '浆细胞乳腺炎', 9), ('d', 8, '乳腺导管扩张症', 8), ('d', 9, '乳管扩张症', 8), ('d', 10, '导管周围乳腺炎', 9), ('d', 11, '乳管周围炎', 8),
  ('d', 12, '乳腺导管炎', 7), ('d', 13, '乳房结核', 9), ('d', 14, '结核性乳腺炎', 9), ('d', 15, '克氏棒状杆菌', 7), ('d', 16, '复发性乳腺炎', 6), ('t', 0, '药物治疗', 4), ('t', 1, '联合用药', 4), ('t', 2, '联合治疗', 3),
  ('t', 3, '三联疗法', 5), ('t', 4, '三联治疗', 5), ('t', 5, '抗结核治疗', 5), ('t', 6, '利福平', 5), ('t', 7, '异烟肼', 5), ('t', 8, '乙胺丁醇', 5), ('t', 9, '吡嗪酰胺', 4), ('t', 10, '甲氨蝶呤', 4), ('t', 11, '泼尼松', 4),
  ('t', 12, '强的松', 4), ('t', 13, '甲泼尼龙', 4), ('t', 14, '地塞米松', 4), ('t', 15, '糖皮质激素', 3), ('t', 16, '类固醇激素', 3), ('t', 17, '抗生素', 3), ('t', 18, '阿莫西林', 3), ('t', 19, '克拉霉素', 3),
  ('t', 20, '阿奇霉素', 3), ('t', 21, '左氧氟沙星', 3), ('t', 22, '庆大霉素', 3), ('t', 23, '治疗', 2), ('t', 24, '疗法', 2), ('t', 25, '疗效', 2), ('t', 26, '诊治', 2), ('t', 27, '疗程', 3), ('t', 28, '复发', 2), ('t', 29, '缓解', 2),
  ('t', 30, '随访', 1), ('t', 31, '预后', 1), ('h', 0, '患者', 3), ('h', 1, '女性', 2), ('h', 2, '病例', 2), ('h', 3, '临床', 2), ('h', 4, '例', 1), ('h', 5, '乳腺', 2), ('h', 6, '乳房', 2), ('h', 7, '病人', 2), ('h', 8, '住院', 1),
  ('v', 0, '奶牛乳腺炎', 12), ('v', 1, '牛乳腺炎', 12), ('v', 2, '奶牛', 10), ('v', 3, '乳牛', 10), ('v', 4, '奶山羊', 10), ('v', 5, '山羊乳腺炎', 12), ('v', 6, '绵羊乳腺炎', 12), ('v', 7, '羊乳腺炎', 11), ('v', 8, '兽医', 10),
  ('v', 9, '畜牧', 8), ('v', 10, '牧场', 7), ('v', 11, '奶牛场', 9), ('v', 12, '产奶量', 8), ('v', 13, '体细胞数', 8), ('v', 14, '乳头浸浴', 8), ('v', 15, '乳区', 5), ('v', 16, '泌乳牛', 9), ('w', 0, '哺乳期乳腺炎', 8),
  ('w', 1, '产褥期乳腺炎', 8), ('w', 2, '母乳喂养', 6), ('w', 3, '产后乳腺炎', 7), ('w', 4, '通乳', 5), ('w', 5, '积乳', 4), ('x', 0, '乳腺癌', 5), ('x', 1, '炎性乳腺癌', 7), ('x', 2, '乳腺肿瘤', 5), ('x', 3, '细胞株', 5),
  ('x', 4, '动物模型', 7)) AS t(kind, place, term, weight))"""


def _decided(source: str, text: str, key: str) -> str:
    """CTEs hits and decided (key, decision, include_score, exclude_score, include_matches, exclude_matches, review_reason)."""
    return f"""{_TERMS}, dense AS (SELECT {key}, regexp_replace(translate(lower({text}), '‐‑–—', '----'), '\\s+', '', 'g') AS z FROM {source}),
hits AS (SELECT {key}, z, kind, place, term, weight FROM dense LEFT JOIN terms ON contains(z, term)),
sums AS (SELECT {key}, coalesce(sum(weight) FILTER (WHERE kind = 'd'), 0) AS d, coalesce(sum(weight) FILTER (WHERE kind = 't'), 0) AS t, coalesce(sum(weight) FILTER (WHERE kind = 'h'), 0) AS h,
  coalesce(sum(weight) FILTER (WHERE kind = 'v'), 0) AS v, coalesce(sum(weight) FILTER (WHERE kind = 'w'), 0) AS w, coalesce(sum(weight) FILTER (WHERE kind = 'x'), 0) AS o,
  coalesce(bool_or(kind = 'd' AND weight >= 8), false) AS strong, any_value(contains(z, '乳腺炎')) AS named,
  coalesce(string_agg(term, '; ' ORDER BY strpos('dth', kind), place) FILTER (WHERE kind IN ('d', 't', 'h')), '') AS include_matches,
  coalesce(string_agg(term, '; ' ORDER BY strpos('vwx', kind), place) FILTER (WHERE kind IN ('v', 'w', 'x')), '') AS exclude_matches FROM hits GROUP BY {key}),
decided AS (SELECT {key}, CASE WHEN v > 0 OR (w >= 6 AND NOT strong) OR (o >= 7 AND NOT strong) THEN 'exclude' WHEN strong AND d + t + h >= v + w + o + 6 THEN 'include'
    WHEN d >= 6 OR (t >= 3 AND h >= 2 AND named) THEN 'review' ELSE 'exclude' END AS decision,
  CAST(d + t + h AS INTEGER) AS include_score, CAST(v + w + o AS INTEGER) AS exclude_score, include_matches, exclude_matches,
  CASE WHEN v > 0 THEN '动物或兽医乳腺炎证据明确' WHEN w >= 6 AND NOT strong THEN '仅见哺乳期或产褥期乳腺炎证据' WHEN o >= 7 AND NOT strong THEN '肿瘤或实验模型信号占主导' WHEN strong AND d + t + h >= v + w + o + 6 THEN ''
    WHEN d >= 6 THEN '目标疾病相关，但题名或正文证据不足以自动进入 strict' WHEN t >= 3 AND h >= 2 AND named THEN '人类乳腺炎治疗相关，但未明确非哺乳期亚型' ELSE '没有明确的目标非哺乳期乳腺炎证据' END AS review_reason FROM sums)"""


_FLAT = "decision AS filter_decision, include_score AS filter_include_score, exclude_score AS filter_exclude_score, include_matches AS filter_include_matches, exclude_matches AS filter_exclude_matches, review_reason AS filter_review_reason"


@query(f"WITH {_D}, {_decided('d', 'text', 'doc_id')} SELECT doc_id, {_FLAT} FROM decided")
def q41_zh_record_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.classify_records_cjk(_texts(spark, sf_dir).select("doc_id", F.col("text").alias("title"))).select("doc_id", *C.decision_columns())


@query(f"""WITH e AS (SELECT conv_id, turn, concat_ws(' ', role, {_signed('text')}) AS text FROM conversations), {_decided('e', 'text', 'conv_id, turn')},
a AS (SELECT conv_id, CASE conv_id % 4 WHEN 0 THEN 'include' WHEN 1 THEN 'review' WHEN 2 THEN 'exclude' END AS article FROM conversations GROUP BY conv_id),
z AS (SELECT conv_id, turn, bool_or(coalesce(kind = 'v', false)) AS animal FROM hits GROUP BY conv_id, turn)
SELECT conv_id, turn, CASE WHEN article IS NULL OR article = 'review' OR (article = 'include' AND animal) THEN 'review' WHEN article = 'exclude' THEN 'excluded' ELSE 'strict' END AS bucket,
  CASE WHEN article IS NULL THEN 'missing_registry' WHEN article = 'exclude' THEN 'article' WHEN article = 'review' THEN 'article_review' WHEN animal THEN 'chunk_animal_review' ELSE 'article' END AS filter_level,
  CASE WHEN article IS NULL OR article = 'review' THEN decided.decision WHEN article = 'include' AND animal THEN 'review' ELSE article END AS shown
FROM decided JOIN z USING (conv_id, turn) JOIN a USING (conv_id)""")
def q42_zh_chunk_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("role").alias("section"), F.expr(_signed("text")).alias("text"))
    own = C.classify_chunks_cjk(turns)
    said = F.when(F.col("conv_id") % 4 == 0, "include").when(F.col("conv_id") % 4 == 1, "review").when(F.col("conv_id") % 4 == 2, "exclude")
    none = F.array().cast("array<string>")
    article = F.when(said.isNotNull(), F.struct(said.alias("decision"), F.lit(0).alias("include_score"), F.lit(0).alias("exclude_score"), none.alias("include_matches"), none.alias("exclude_matches"), F.lit("").alias("review_reason")))
    return C.route_chunks_cjk(own.withColumn("article", article)).select("conv_id", "turn", "bucket", "filter_level", F.col("shown.decision").alias("shown"))


_C = "[㐀-䶿一-鿿]"


def _fold(x: str) -> str:
    """Folded text without blanks between ideographs; a pass of its own for those that share an ideograph."""
    plain = f"trim(regexp_replace(replace(replace({x}, chr(160), ' '), chr(12288), ' '), '[ \\t\\r\\n]+', ' ', 'g'))"
    return f"regexp_replace(regexp_replace({plain}, '({_C})\\s+({_C})', '\\1\\2', 'g'), '({_C})\\s+({_C})', '\\1\\2', 'g')"


_PIECES = f"""p0 AS (SELECT doc_id, regexp_extract_all({_fold('text')}, '(.+?(?:[。！？!?；;]+[”’"）)\\]]*|$))') AS l FROM d),
p1 AS (SELECT doc_id, k, {_fold('l[k]')} AS p FROM p0, unnest(range(1, len(l) + 1)) AS u(k)),
p2 AS (SELECT doc_id, k, p, length(regexp_replace(p, '[^\\p{{L}}\\p{{M}}\\p{{N}}_]', '', 'g')) < 6 AND NOT regexp_matches(p, '[。！？!?；;]$') AS scrap FROM p1 WHERE p <> ''),
p3 AS (SELECT *, count(*) FILTER (WHERE NOT scrap) OVER (PARTITION BY doc_id ORDER BY k) - CASE WHEN scrap THEN 0 ELSE 1 END AS g, count(*) FILTER (WHERE NOT scrap) OVER (PARTITION BY doc_id) AS whole FROM p2),
s AS (SELECT doc_id, least(g, greatest(whole - 1, 0)) AS g, string_agg(p, '' ORDER BY k) AS sentence FROM p3 GROUP BY ALL)"""


@query(f"WITH {_D}, {_PIECES} SELECT doc_id, CAST(g AS INTEGER) AS k, sentence FROM s")
def q43_zh_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select("doc_id", F.posexplode_outer(ST.split_sentences_cjk("text")).alias("k", "sentence")).where("k is not null")


@query(f"""WITH {_D}, l0 AS (SELECT doc_id, string_split(replace(text, ' ', '-' || chr(10)), chr(10)) AS l FROM d),
l AS (SELECT doc_id, k, {_fold('l[k]')} AS x FROM l0, unnest(range(1, len(l) + 1)) AS u(k)),
n AS (SELECT doc_id, k, x, lead(x) OVER (PARTITION BY doc_id ORDER BY k) AS y FROM l WHERE x <> ''),
j AS (SELECT doc_id, k, CASE WHEN y IS NULL OR (regexp_matches(x, '{_C}$') AND regexp_matches(y, '^{_C}')) THEN x WHEN x LIKE '%-' THEN left(x, length(x) - 1) ELSE concat(x, ' ') END AS x FROM n)
SELECT doc_id, {_fold("string_agg(x, '' ORDER BY k)")} AS joined FROM j GROUP BY doc_id""")
def q44_zh_join_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.split(F.replace("text", F.lit(" "), F.lit("-\n")), "\n", -1)
    # Whether anything is left is told by the lines: a filter on what they give would move before it and join them a second time.
    return _texts(spark, sf_dir).where(F.replace("text", F.lit(" "), F.lit("-\n")).rlike("[^ \t\r\n\u00a0\u3000]")).select("doc_id", ST.join_lines_cjk(lines).alias("joined"))


#: Lines that are headings, or nearly, with what they are, by hand.
_LINES = [
    ("一、结果", "结果"), ("1.2 结果", "结果"), ("2 资料与方法", "资料与方法"), ("【摘要】", "摘要"), ("第三章 讨论", "讨论"), ("结果表明疗效好", None), ("12", None), ("3.1.2、一般资料", "临床资料"),
    ("并发症", "不良反应"), ("1．治疗方案", "治疗方法"), ("主要参考文献", "参考文献"), ("前 言", "引言"), ("1.5 倍", None), ("纳入标准", "纳入与排除标准"), ("统计学处理", "统计学方法"), ("疗效评价", "评价指标"), ("小结", "结论"), ("", None),
]
_LINE_SQL = "CASE doc_id % 18 " + " ".join(f"WHEN {k} THEN '{a}'" for k, (a, _) in enumerate(_LINES)) + " END"


@query("SELECT doc_id, CASE doc_id % 18 " + " ".join(f"WHEN {k} THEN '{b}'" for k, (_, b) in enumerate(_LINES) if b) + " END AS heading FROM documents")
def q45_zh_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.expr(_LINE_SQL).alias("line")).select("doc_id", P.heading("line").alias("heading"))


_LIMITS = K.Limits(least=30, most=90, most_chars=260)
_UNITS = f"{_C}|[A-Za-z0-9]+(?:[-''][A-Za-z0-9]+)?"


def _join(lines: str) -> str:
    """Sentences as running text. Lines are folded already, none is empty."""
    glue = f"CASE WHEN regexp_matches(a, '{_C}$') AND regexp_matches(x, '^{_C}') THEN a || x WHEN a LIKE '%-' THEN left(a, length(a) - 1) || x ELSE a || ' ' || x END"
    return f"list_reduce({lines}, lambda a, x: {glue})"


def _size(lines: str) -> str:
    return f"len(regexp_extract_all({_join(lines)}, '{_UNITS}'))"


_FITS = f"{_size('s[{0}:{1}]')} <= 90 AND length({_join('s[{0}:{1}]')}) <= 260"
#: Every second sentence is a cut; ranges are merged under 30 units, the last one backward, and split over 90 units or 260 characters.
_ZH_RANGES = f"""z AS (SELECT doc_id, list(sentence ORDER BY g) AS s FROM s GROUP BY doc_id),
r AS (SELECT doc_id, s, list_transform(range(0, CAST(ceil(len(s) / 2) AS BIGINT)), lambda k: {{'start': k * 2, 'stop': least(k * 2 + 2, len(s))}}) AS r FROM z),
f AS (SELECT doc_id, s, list_reduce(range(2, len(r) + 1), lambda a, k: CASE WHEN {_size('s[a.p.start + 1:a.p.stop]')} < 30 AND {_FITS.format('a.p.start + 1', 'r[k].stop')}
  THEN {{'p': {{'start': a.p.start, 'stop': r[k].stop}}, 'done': a.done}} ELSE {{'p': r[k], 'done': list_append(a.done, a.p)}} END, {{'p': r[1], 'done': []::STRUCT(start BIGINT, stop BIGINT)[]}}) AS a FROM r),
m AS (SELECT doc_id, s, CASE WHEN len(a.done) > 0 AND {_size('s[a.p.start + 1:a.p.stop]')} < 30 AND {_FITS.format('a.done[-1].start + 1', 'a.p.stop')}
  THEN list_append(a.done[1:len(a.done) - 1], {{'start': a.done[-1].start, 'stop': a.p.stop}}) ELSE list_append(a.done, a.p) END AS r FROM f),
e AS (SELECT doc_id, s, r[j] AS x FROM m, unnest(range(1, len(r) + 1)) AS u(j)),
h AS (SELECT doc_id, s, x, list_transform(s, lambda p: len(regexp_extract_all(p, '{_UNITS}'))) AS n, NOT ({_FITS.format('x.start + 1', 'x.stop')}) AS big FROM e),
g2 AS (SELECT doc_id, x, big, list_reduce(range(x.start, x.stop), lambda a, i: CASE WHEN i > a.st AND (a.w + n[i + 1] > 90 OR a.c + CASE WHEN a.c > 0 THEN 1 ELSE 0 END + length(s[i + 1]) > 260)
  THEN {{'st': i, 'w': n[i + 1], 'c': length(s[i + 1]), 'done': list_append(a.done, {{'start': a.st, 'stop': i}})}}
  ELSE {{'st': a.st, 'w': a.w + n[i + 1], 'c': a.c + CASE WHEN a.c > 0 THEN 1 ELSE 0 END + length(s[i + 1]), 'done': a.done}} END,
  {{'st': x.start, 'w': 0::BIGINT, 'c': 0::BIGINT, 'done': []::STRUCT(start BIGINT, stop BIGINT)[]}}) AS a FROM h),
parts AS (SELECT doc_id, unnest(CASE WHEN big THEN list_append(a.done, {{'start': a.st, 'stop': x.stop}}) ELSE [x] END) AS p FROM g2)"""


@query(f"WITH {_D}, {_PIECES}, {_ZH_RANGES} SELECT doc_id, CAST(p.start AS INTEGER) AS start, CAST(p.stop AS INTEGER) AS stop FROM parts")
def q46_zh_chunk_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    def ranged(s):
        n = F.transform(s, T.unit_count)
        r = K.ranges(F.size(s), F.transform(F.sequence(F.lit(1), F.size(s)), lambda k: k * 2))
        return K.split_oversized(K.merge_short(r, n, _LIMITS, s, backward=True), n, _LIMITS, s)

    none = F.array().cast("array<struct<start:int,stop:int>>")
    # explode_outer: Spark lets a filter on the array's size go before explode, which would make the ranges twice.
    said = _texts(spark, sf_dir).select("doc_id", F.explode_outer(T.let(ST.split_sentences_cjk("text"), lambda s: F.when(F.size(s) > 0, ranged(s)).otherwise(none))).alias("r"))
    return said.where("r is not null").select("doc_id", "r.start", "r.stop")


@query(f"""WITH {_D}, m AS (SELECT *, len(regexp_extract_all(text, '[A-Za-z0-9㐀-䶿一-鿿]')) AS chars, len(regexp_extract_all(text, '{_C}')) AS cjk FROM d),
w AS (SELECT source, chars, cjk, CASE WHEN doc_id % 3 = 0 THEN 'ocr' WHEN chars >= 60 AND cjk >= 20 THEN 'native_text' WHEN doc_id % 3 = 1 THEN 'ocr' ELSE 'native_low_text' END AS method, chars < 60 AS low_text FROM m)
SELECT source, count(*) AS page_count, count(*) FILTER (WHERE method IN ('native_text', 'native_low_text')) AS native_pages, count(*) FILTER (WHERE method = 'ocr') AS ocr_pages,
  count(*) FILTER (WHERE low_text) AS low_text_pages, CAST(sum(chars) AS BIGINT) AS text_char_count, CAST(sum(cjk) AS BIGINT) AS cjk_char_count FROM w GROUP BY source""")
def q47_zh_page_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    mode = F.col("doc_id") % 3
    method = F.when(mode == 0, T.extraction_method("text", "always")).when(mode == 1, T.extraction_method("text")).otherwise(T.extraction_method("text", "never"))
    pages = _texts(spark, sf_dir).select("source", method.alias("extraction_method"), (T.content_chars("text") < 60).alias("low_text"), T.content_chars("text").alias("text_char_count"), T.cjk_chars("text").alias("cjk_char_count"))
    return P.page_totals(pages, "source")


_KEY = "regexp_replace(lower(regexp_replace({}, '\\s+', '', 'g')), '(第)?[0-9]+(页)?', '#', 'g')"


@query(f"""WITH w AS (SELECT source, doc_id, text FROM documents), p AS (SELECT source, doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_replace(x, '\\s+', '', 'g') <> '') AS l FROM w),
e AS (SELECT DISTINCT source, doc_id, {_KEY.format('x')} AS key FROM (SELECT source, doc_id, unnest(list_concat(l[1:2], l[greatest(len(l) - 1, 1):])) AS x FROM p) WHERE NOT regexp_matches(x, '[。！？!?；;]')),
t AS (SELECT source, count(*) AS pages FROM w GROUP BY source),
k AS (SELECT source, key FROM e JOIN t USING (source) WHERE length(key) BETWEEN 2 AND 80 GROUP BY source, key, pages HAVING pages >= 3 AND count(*) >= greatest(3, CAST(floor(pages * 0.05 + 0.999) AS INTEGER))),
i AS (SELECT source, doc_id, u.n, l[u.n] AS x FROM (SELECT source, doc_id, string_split(regexp_replace(text, chr(10) || '$', ''), chr(10)) AS l FROM w), unnest(range(1, len(l) + 1)) AS u(n)),
o AS (SELECT i.source, i.doc_id, i.n, trim(regexp_replace(replace(i.x, chr(160), ' '), '[ \\t]+', ' ', 'g')) AS x FROM i LEFT JOIN k ON k.source = i.source AND k.key = {_KEY.format('i.x')} AND NOT regexp_matches(i.x, '[。！？!?；;]')
  WHERE k.key IS NULL AND NOT regexp_matches(regexp_replace(i.x, '\\s+', '', 'g'), '^(第)?[-—–]?[0-9]+[-—–]?(页)?$')),
j AS (SELECT source, doc_id, trim(regexp_replace(string_agg(x, chr(10) ORDER BY n), '\\n{{3,}}', chr(10) || chr(10), 'g'), chr(10)) AS text FROM o GROUP BY ALL),
c AS (SELECT w.doc_id, CASE WHEN t.pages >= 3 THEN coalesce(j.text, '') ELSE w.text END AS text FROM w JOIN t USING (source) LEFT JOIN j USING (source, doc_id))
SELECT doc_id, text, CAST(len(regexp_extract_all(text, '[A-Za-z0-9㐀-䶿一-鿿]')) AS INTEGER) AS text_char_count, CAST(len(regexp_extract_all(text, '{_C}')) AS INTEGER) AS cjk_char_count FROM c""")
def q48_without_margins(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "documents").select("source", "doc_id", "text")
    return P.without_margins(pages, "source", "doc_id", "text", 0.05).select("doc_id", "text", "text_char_count", "cjk_char_count")


@query("""WITH p AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN ['a b', 'c'] WHEN 1 THEN ['a b', 'c', ''] ELSE ['a b' || chr(10) || 'c'] END AS pages FROM documents)
SELECT doc_id, concat('page one', chr(10), '第', doc_id, '页', chr(10), chr(10), 'two words', chr(10), chr(10), 'end') AS page, pages FROM p""")
def q49_page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages put in order (a page normalised; form feeds cut to the number of pages), the results by hand."""
    raw = F.concat(F.lit("\n\npage one\r第"), "doc_id", F.lit("页\n　\n two \t words\n\n\n\nend\n"))
    count = F.when(F.col("doc_id") % 3 == 0, 2).when(F.col("doc_id") % 3 == 1, 3).otherwise(1)
    return table(spark, sf_dir, "documents").select("doc_id", T.normalize_page(raw).alias("page"), T.split_pages(F.lit(" a  b\fc\f "), count).alias("pages"))

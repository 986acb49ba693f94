"""Page text: margins that repeat across pages, sections carried over lines and pages, caches of parsed pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.functions.sentences import join_lines_cjk, split_sentences_cjk, with_limits
from quillspark.functions.text import SPACE, cjk_chars, col, content_chars, fold_cjk, given, header_key, let, normalize_page, unspaced

_STOP = r"[。！？!?；;]"
_PAGE_NUMBER = r"(?U)^(?:第)?[-—–]?\d+[-—–]?(?:页)?$"
#: What lines of page numbers consist of; most others end such a search at once.
_OF_PAGE_NUMBERS = r"(?U)^[\s\x1C-\x1F\d第页\-—–]*$"
#: Documents whose repeated margins (at most four for the share of pages that a margin takes) may be sent to every task.
MOST_SENT = 1_000
_LINES = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\u0085  ]"

#: Headings by their canonical name: what a whole line must be.
HEADINGS = {
    "摘要": "(?:中文)?摘要",
    "关键词": "关键[词字]",
    "引言": "引言|前言|绪论",
    "资料与方法": "(?:资料|材料|对象|病例|临床资料|仪器)[与和]方法|(?:研究|实验)方法",
    "临床资料": "(?:一般|临床)资料|研究对象",
    "治疗方法": "治疗(?:方法|方案)|方法",
    "诊断": "诊断(?:标准)?",
    "纳入与排除标准": "(?:纳入|排除|纳入与排除)标准",
    "评价指标": "(?:观察|评价)指标|疗效评价",
    "疗效标准": "疗效(?:判定)?标准",
    "统计学方法": "统计学(?:方法|处理)",
    "结果": "(?:研究)?结果",
    "不良反应": "不良反应|并发症",
    "随访与预后": "随访|预后",
    "讨论": "(?:分析与)?讨论",
    "结论": "结论|小结",
    "参考文献": "(?:主要)?参考文献",
}
#: Words that open a heading whose number stands apart by a blank only.
_OPENING = "|".join("一般 不良反应 临床 仪器 关键词 分析 前言 对象 小结 引言 指标 排除 摘要 方案 方法 机制 材料 治疗 疗效 病例 病因 研究 纳入 结果 结论 统计 绪论 观察 讨论 评价 诊断 资料 随访".split())
BODY, REFERENCES = "正文", "参考文献"


def lines_of(text: str | Column) -> Column:
    """The lines of a text; none after a break at its end."""
    return F.split(F.regexp_replace(given(text), rf"(?:{_LINES})$", ""), _LINES, -1)


def _lines_of_pages(pages: DataFrame, document: str, page: str, text: str) -> DataFrame:
    return pages.select(document, page, F.posexplode(lines_of(text)).alias("line_no", "line"))


def repeated_margins(pages: DataFrame, document: str = "document_id", page: str = "page_number", text: str = "text", share: float = 0.30) -> DataFrame:
    """(document, key): header and footer keys among the first and last two lines of at least three pages and a share of all."""

    def edge(lines: Column) -> Column:
        return F.concat(F.slice(lines, F.lit(1), F.lit(2)), F.slice(lines, F.greatest(F.size(lines) - 1, F.lit(1)), F.lit(2)))

    full = F.filter(lines_of(text), lambda x: x.rlike(r"(?U)[^\s\x1C-\x1F]"))
    plain = F.filter(let(full, edge), lambda x: ~x.rlike(_STOP))
    keys = F.filter(F.array_distinct(F.transform(plain, header_key)), lambda k: F.length(k).between(2, 80))
    each = pages.select(document, F.explode_outer(keys).alias("key")).where("key is not null")  # not explode: its array would be made a second time, to filter by size
    totals = pages.groupBy(document).agg(F.count("*").alias("pages"))
    counts = each.groupBy(document, "key").agg(F.count("*").alias("n"))
    enough = F.greatest(F.lit(3), F.floor(F.col("pages") * share + 0.999).cast("int"))
    return counts.join(totals, document).where((F.col("pages") >= 3) & (F.col("n") >= enough)).select(document, "key")


def without_margins(pages: DataFrame, document: str = "document_id", page: str = "page_number", text: str = "text", share: float = 0.30) -> DataFrame:
    """pages without repeated margins and bare page numbers, counts of characters renewed; documents of fewer than three pages stay as they are.

    low_text, where a table has it, is not renewed.
    """
    totals = pages.groupBy(document).agg(F.count("*").alias("__pages"))
    repeated = repeated_margins(pages, document, page, text, share).groupBy(document).agg(F.collect_set("key").alias("__keys"))
    facts = totals.join(repeated, document, "left").withColumn("__keys", F.coalesce("__keys", F.array().cast("array<string>")))
    if totals.limit(MOST_SENT + 1).count() <= MOST_SENT:  # else pages are shuffled by their document
        facts = F.broadcast(facts)
    joined = pages.join(facts, document, "left")

    def number(x: Column) -> Column:
        return x.rlike(_OF_PAGE_NUMBERS) & unspaced(x).rlike(_PAGE_NUMBER)

    keys = F.col("__keys")
    lines = F.filter(lines_of(text), lambda x: ~(number(x) | ((F.size(keys) > 0) & ~x.rlike(_STOP) & F.array_contains(keys, header_key(x)))))
    clean = F.when(F.col("__pages") >= 3, normalize_page(F.array_join(lines, "\n"))).otherwise(F.col(text))
    out = joined.withColumn(text, clean).drop("__keys", "__pages")
    return out.withColumns({"text_char_count": content_chars(text), "cjk_char_count": cjk_chars(text)}).select(*pages.columns, *(c for c in ("text_char_count", "cjk_char_count") if c not in pages.columns))


def title_after_number(line: Column) -> Column:
    """The rest of a line after a section number; null if it has none."""
    start = f"^(?:{_OPENING})"

    def rest(pattern: str) -> Column:
        return F.trim(F.regexp_replace(line, pattern, ""))

    chapter, chinese = r"^第[一二三四五六七八九十]+[章节](?U)\s*", r"^[一二三四五六七八九十]+、(?U)\s*"
    dotted, dotted_space = r"^[0-9]{1,2}(?:\.[0-9]+){1,3}[、．]", r"^[0-9]{1,2}(?:\.[0-9]+){1,3}(?U)\s+"
    single, single_space = r"^[0-9]{1,2}[、．.]", r"^[0-9]{1,2}(?U)\s+"
    direct = r"^[0-9]{1,2}(?:\.[0-9]+){0,3}"
    return (
        F.when(line.rlike(chapter), rest(chapter))
        .when(line.rlike(chinese), rest(chinese))
        .when(line.rlike(dotted), rest(dotted))
        .when(line.rlike(dotted_space), F.when(rest(dotted_space).rlike(start), rest(dotted_space)))
        .when(line.rlike(single), rest(single))
        .when(line.rlike(single_space), F.when(rest(single_space).rlike(start), rest(single_space)))
        .when(line.rlike(direct), F.when(rest(direct).rlike(start), rest(direct)))
    )


def heading(line: str | Column) -> Column:
    """The canonical heading a line is; null if it is none."""

    def named(candidate: Column) -> Column:
        found = F.lit(None).cast("string")
        for name, pattern in reversed(HEADINGS.items()):
            found = F.when(candidate.rlike(f"^(?:{pattern})$"), name).otherwise(found)
        return found

    plain = F.regexp_replace(fold_cjk(line), r"(?U)^[\s【\[]+|[\s】\]]+$", "")
    return let(plain, lambda p: let(F.coalesce(title_after_number(p), p), named))


def carry_forward(df: DataFrame, group: list[str], order: list[str], mark: str, into: str, default: str = BODY) -> DataFrame:
    """Each row's last mark that is not null, in order within its group; default before the first."""
    w = W.partitionBy(*group).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn(into, F.coalesce(F.last(mark, ignorenulls=True).over(w), F.lit(default)))


def sections(pages: DataFrame, include_references: bool = False, document: str = "document_id", page: str = "page_number") -> DataFrame:
    """(document, section, sentences: array<struct<text, page_number, extraction_method>>, first) of documents' pages.

    A heading holds until the next, across pages; running text ends with its page; a heading that returns continues its section.
    """
    lines = pages.select(document, F.col(page).alias("page_number"), given("extraction_method").alias("extraction_method"), fold_cjk("title").alias("__title"), F.posexplode(lines_of("text")).alias("line_no", "raw"))
    lines = lines.withColumn("line", fold_cjk("raw")).where("line <> ''")
    squeezed = F.regexp_replace("__title", SPACE, "")
    is_title = (squeezed != "") & (F.regexp_replace(F.regexp_replace("line", SPACE, ""), r"^[【】\[\]]+|[【】\[\]]+$", "") == squeezed)
    marked = lines.withColumn("mark", F.when(~is_title, heading("line")))
    held = carry_forward(marked, [document], ["page_number", "line_no"], "mark", "section")
    runs = W.partitionBy(document).orderBy("page_number", "line_no").rowsBetween(W.unboundedPreceding, 0)
    held = held.withColumn("run", F.count("mark").over(runs)).where("mark is null")
    if not include_references:
        held = held.where(F.col("section") != REFERENCES)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"])
    blocks = held.groupBy(document, "section", "page_number", "run").agg(ordered.alias("lines"), F.min("extraction_method").alias("extraction_method"))
    said = with_limits(blocks.withColumn("s", split_sentences_cjk(join_lines_cjk("lines"))).drop("lines"), "s")
    said = said.withColumn("s", F.transform("s", lambda x: F.struct(x.alias("text"), F.col("page_number").alias("page_number"), F.col("extraction_method").alias("extraction_method"))))
    whole = said.groupBy(document, "section").agg(F.array_sort(F.collect_list(F.struct("page_number", "run", "s"))).alias("__b"))
    return whole.select(document, "section", F.flatten(F.transform("__b", lambda b: b["s"])).alias("sentences"), F.struct(F.get("__b", F.lit(0))["page_number"].alias("page"), F.get("__b", F.lit(0))["run"].alias("run")).alias("first")).where("size(sentences) > 0")


def page_totals(pages: DataFrame, document: str = "document_id") -> DataFrame:
    """Counts for each document by how its pages were had."""
    method = F.col("extraction_method")
    return pages.groupBy(document).agg(
        F.count("*").alias("page_count"),
        F.count_if(method.isin("native_text", "native_low_text")).alias("native_pages"),
        F.count_if(method == "ocr").alias("ocr_pages"),
        F.count_if(F.col("low_text")).alias("low_text_pages"),
        F.sum("text_char_count").alias("text_char_count"),
        F.sum("cjk_char_count").alias("cjk_char_count"),
    )


def cache_complete(pages: DataFrame, expected: DataFrame, document: str = "document_id", seq: str = "seq") -> DataFrame:
    """(document, complete): whether the cached pages of each expected document (document, page_count) are 1 to page_count, in order."""
    numbers = pages.groupBy(document).agg(F.transform(F.array_sort(F.collect_list(F.struct(seq, "page_number"))), lambda x: x["page_number"].cast("int")).alias("__n"))
    whole = F.when(F.col("page_count") > 0, F.sequence(F.lit(1), F.greatest(col("page_count").cast("int"), F.lit(1)))).otherwise(F.array().cast("array<int>"))
    return expected.join(numbers, document, "left").select(document, (F.coalesce("__n", F.array().cast("array<int>")) == whole).alias("complete"))

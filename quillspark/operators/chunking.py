"""Chunking: gap windows, semantic boundaries, and the folds that turn boundaries into ranges of sentences.

All folds work on arrays of one section, so sections spread over the cluster. Sentences are split, counted and joined by expressions in the JVM.
Folds whose state is text are ``aggregate`` expressions; those over sizes alone run in Arrow batches, where only
whole numbers travel: as expressions they copied their state at every step and took most of a query's time.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from dataclasses import dataclass
from itertools import accumulate

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.sentences import join_lines_cjk, split_sentences
from quillspark.functions.text import col, fold, given, let, section_key, slug, unit_count, word_count
from quillspark.functions.vectors import cosine
from quillspark.operators.registry import record_identifier

#: Functions of this module travel whole, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_RANGES = "array<struct<start:int,stop:int>>"


@dataclass(frozen=True)
class Limits:
    """Sizes of chunks in sentences and in words (English) or units (Chinese)."""

    min_sentences: int = 2
    max_sentences: int = 12
    window: int = 2
    percentile: float = 20.0
    margin: float = 0.02
    least: int = 80
    most: int = 360
    most_chars: int = 4000


EN, CJK = Limits(), Limits(least=180, most=900)
#: For chunks cut at given boundaries only.
UNLIMITED = Limits(least=0, most=10_000)


def gap_windows(sentences: str | Column, window: int = 2, glue: str = " ") -> Column:
    """array<struct<left, right>>: for each gap the joined sentences before and after it."""
    s = col(sentences)
    return F.transform(
        F.sequence(F.lit(1), F.size(s) - 1),
        lambda g: F.struct(
            F.array_join(F.slice(s, F.greatest(g - (window - 1), F.lit(1)), F.least(g, F.lit(window))), glue).alias("left"),
            F.array_join(F.slice(s, g + 1, F.lit(window)), glue).alias("right"),
        ),
    )


def windows_of(sentences: str | Column, window: int = 2, glue: str = " ") -> Column:
    """:func:`gap_windows`, empty for fewer than two sentences."""
    none = F.array().cast("array<struct<left:string,right:string>>")
    return let(sentences, lambda s: F.when(F.size(s) >= 2, gap_windows(s, window, glue)).otherwise(none))


def gap_similarities(left: str | Column, right: str | Column) -> Column:
    """array<double>: the cosine of each gap's two window vectors."""
    return F.transform(F.arrays_zip(col(left).alias("a"), col(right).alias("b")), lambda p: cosine(p["a"], p["b"]))


def percentile(values: str | Column, q: float) -> Column:
    """Linear interpolation between the closest ranks of an array; 0 if it is empty."""

    def between(v: Column) -> Column:
        n = F.size(v)
        at = (n - 1) * F.lit(min(max(q, 0.0), 100.0) / 100.0)
        low = F.floor(at).cast("int")
        a, b, w = F.get(v, low), F.get(v, F.least(low + 1, n - 1)), at - low
        return F.when(n == 0, F.lit(0.0)).when(w == 0, a).otherwise(a * (1 - w) + b * w)

    return let(F.array_sort(col(values)), between)


def is_valley(scores: Column, i: Column, margin: float) -> Column:
    """Whether a score is below both neighbours by a margin; a missing neighbour is infinitely high."""
    high = F.lit(float("inf"))
    here, before, after = F.get(scores, i), F.when(i > 0, F.get(scores, i - 1)).otherwise(high), F.coalesce(F.get(scores, i + 1), high)
    return (here <= before - margin) & (here <= after - margin)


def boundaries(similarities: str | Column, limits: Limits = EN) -> Column:
    """array<int>: sentence counts after which to cut, scanning left to right with the start of the current chunk as state."""
    none = F.array().cast("array<int>")
    start = F.struct(F.lit(0).alias("st"), none.alias("cuts"))

    def scan(s: Column, threshold: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            after = i + 1
            count, remaining = after - acc["st"], F.size(s) + 1 - after
            quiet = (F.get(s, i) <= threshold) & is_valley(s, i, limits.margin)
            cut = (count >= limits.max_sentences) | ((count >= limits.min_sentences) & (remaining >= limits.min_sentences) & quiet)
            return F.when(cut, F.struct(after.alias("st"), F.array_append(acc["cuts"], after).alias("cuts"))).otherwise(acc)

        return F.aggregate(F.sequence(F.lit(0), F.size(s) - 1), start, step, lambda acc: acc["cuts"])

    return let(similarities, lambda s: F.when(F.size(s) > 0, let(percentile(s, limits.percentile), lambda q: scan(s, q))).otherwise(none))


def ranges(count: str | Column, cuts: str | Column) -> Column:
    """Half-open ranges from distinct cuts inside the sentences."""
    n = col(count).cast("int")
    inside = F.array_sort(F.array_distinct(F.filter(col(cuts), lambda c: (c > 0) & (c < n))))
    # No lambda within another's: Python functions over such arguments aren't evaluated.
    return F.zip_with(F.concat(F.array(F.lit(0)), inside), F.concat(inside, F.array(n)), lambda a, b: F.struct(a.alias("start"), b.alias("stop")))


def _from_stops(first: Column, stops: Column) -> Column:
    """Neighbouring ranges from where the first begins and where each ends. Folds keep the ends only: their state is copied at every step."""
    return F.zip_with(F.concat(F.array(first), F.slice(stops, F.lit(1), F.size(stops) - 1)), stops, lambda a, b: F.struct(a.alias("start"), b.alias("stop")))


def _joined(texts: Column, r: Column) -> Column:
    return join_lines_cjk(F.slice(texts, r["start"] + 1, r["stop"] - r["start"]))


def _totals(sizes) -> list[int]:
    return [0, *accumulate(map(int, sizes))]


def merged_stops(first: int, stops: list[int], sizes, limits: Limits, backward: bool = False) -> list[int]:
    """Where neighbouring ranges end once short ones are joined to the next while both stay within limits."""
    total, start, stop, out = _totals(sizes), first, stops[0], []
    for following in stops[1:]:
        if total[stop] - total[start] < limits.least and total[following] - total[start] <= limits.most:
            stop = following
        else:
            out.append(stop)
            start, stop = stop, following
    if backward and out and total[stop] - total[start] < limits.least and total[stop] - total[out[-2] if len(out) > 1 else first] <= limits.most:
        out.pop()
    return [*out, stop]


def cut_stops(first: int, stops: list[int], sizes, limits: Limits) -> list[int]:
    """Where neighbouring ranges end once those over the limit are cut between sentences."""
    total, start, out = _totals(sizes), first, []
    for stop in stops:
        if total[stop] - total[start] > limits.most:
            begin = start
            for i in range(start, stop):
                if i - begin + 1 > limits.min_sentences and total[i + 1] - total[begin] > limits.most:
                    out.append(i)
                    begin = i
        out.append(stop)
        start = stop
    return out


def packed_stops(sizes, most: int) -> list[int]:
    """Where ranges end that are packed in order up to a size."""
    total, begin, out = _totals(sizes), 0, []
    for i in range(len(total) - 1):
        if i > begin and total[i + 1] - total[begin] > most:
            out.append(i)
            begin = i
    return [*out, len(total) - 1] if len(total) > 1 else []


def _over_sizes(found: Column, sizes: Column, fold: Callable[[int, list[int], object], list[int]]) -> Column:
    """A fold of neighbouring ranges and sizes, in Arrow batches of whole numbers.

    Neither may hold a lambda that names another lambda's variable, unless it is a column of its own: Spark doesn't evaluate Python functions over such.
    """

    @F.pandas_udf("array<int>")
    def folded(starts: pd.Series, stops: pd.Series, sizes: pd.Series) -> pd.Series:
        return pd.Series([None if b is None else [] if not len(b) else fold(int(a[0]), [int(x) for x in b], n) for a, b, n in zip(starts, stops, sizes)], dtype=object)

    # Not said to be deterministic, so that a filter on the result isn't moved before it and evaluated a second time.
    stops = folded.asNondeterministic()(F.transform(found, lambda r: r["start"]), F.transform(found, lambda r: r["stop"]), sizes)
    return F.when(F.size(found) > 0, _from_stops(F.get(found, F.lit(0))["start"], stops)).otherwise(F.array().cast(_RANGES))


def merge_short(found: str | Column, sizes: str | Column, limits: Limits = EN, texts: str | Column | None = None, backward: bool = False) -> Column:
    """Ranges with short ones joined to the next while both together stay within limits.

    sizes: words or units of each sentence. With texts, sizes must be their units; units and characters are then those of the sentences joined as running
    text. backward: a short last range is joined to the one before it.
    """
    if limits.least <= 0:
        return col(found)
    if texts is None:
        return _over_sizes(col(found), col(sizes), lambda first, stops, n: merged_stops(first, stops, n, limits, backward))
    return let(_bound(found, sizes, texts), lambda v: _merged(v["r"], v["t"], v["n"], v["l"], limits, backward))


def _bound(found: str | Column, sizes: str | Column, texts: str | Column) -> Column:
    """Ranges, sentences, and each sentence's units and characters, evaluated once."""
    return F.struct(col(found).alias("r"), col(sizes).alias("n"), col(texts).alias("t"), F.transform(col(texts), lambda x: F.length(given(x))).alias("l"))


def _measured(x: Column, units: Column, chars: Column) -> Column:
    """A range with bounds of its joined text: at most n units and c characters, and at least n - m units, as a hyphen at a sentence's end may join two words."""

    def total(sizes: Column) -> Column:
        return F.aggregate(F.slice(sizes, x["start"] + 1, x["stop"] - x["start"]), F.lit(0), lambda a, n: a + n)

    m = x["stop"] - x["start"] - 1
    return F.struct(x["start"].alias("start"), x["stop"].alias("stop"), total(units).alias("n"), (total(chars) + m).alias("c"), m.alias("m"))


def _fits(x: Column, lines: Column, limits: Limits) -> Column:
    """Whether a measured range is within limits; its text is joined only where the bounds don't tell."""
    exact = let(_joined(lines, x), lambda t: (F.length(t) <= limits.most_chars) & (unit_count(t) <= limits.most))
    return F.when((x["n"] <= limits.most) & (x["c"] <= limits.most_chars), True).when(x["n"] - x["m"] > limits.most, False).otherwise(exact)


def _merged(r: Column, lines: Column, units: Column, chars: Column, limits: Limits, backward: bool) -> Column:
    def joined(a: Column, b: Column) -> Column:
        """Two neighbouring ranges as one, with its bounds."""
        return F.struct(a["start"].alias("start"), b["stop"].alias("stop"), (a["n"] + b["n"]).alias("n"), (a["c"] + b["c"] + 1).alias("c"), (a["m"] + b["m"] + 1).alias("m"))

    def short(x: Column) -> Column:
        return F.when(x["n"] < limits.least, True).when(x["n"] - x["m"] >= limits.least, False).otherwise(unit_count(_joined(lines, x)) < limits.least)

    def step(acc: Column, x: Column) -> Column:
        p = acc["p"]
        apart = F.struct(x.alias("p"), p.alias("q"), F.array_append(acc["stops"], p["stop"]).alias("stops"))
        return F.when(short(p), let(joined(p, x), lambda both: F.when(_fits(both, lines, limits), F.struct(both.alias("p"), acc["q"].alias("q"), acc["stops"].alias("stops"))).otherwise(apart))).otherwise(apart)

    def finish(acc: Column) -> Column:
        stops, p = acc["stops"], acc["p"]
        if backward:  # q is the range before the last
            join = (F.size(stops) > 0) & short(p) & let(joined(acc["q"], p), lambda both: _fits(both, lines, limits))
            stops = F.when(join, F.slice(stops, F.lit(1), F.size(stops) - 1)).otherwise(stops)
        return F.array_append(stops, p["stop"])

    def fold(m: Column) -> Column:
        one = F.get(m, F.lit(0))
        first = F.struct(one.alias("p"), one.alias("q"), F.array().cast("array<int>").alias("stops"))
        return _from_stops(one["start"], F.aggregate(F.slice(m, F.lit(2), F.size(m)), first, step, finish))

    return F.when(F.size(r) > 1, let(F.transform(r, lambda x: _measured(x, units, chars)), fold)).otherwise(r)


def split_oversized(found: str | Column, sizes: str | Column, limits: Limits = EN, texts: str | Column | None = None) -> Column:
    """Ranges over the limits cut between sentences.

    By words a range is cut only once it holds min_sentences, so a chunk may exceed the limit; with texts the
    characters are limited too, any second sentence may be cut off, and blanks between sentences count.
    """
    if texts is None:
        return _over_sizes(col(found), col(sizes), lambda first, stops, n: cut_stops(first, stops, n, limits))
    return let(_bound(found, sizes, texts), lambda v: _split(v["r"], v["n"], v["t"], v["l"], limits))


def _split(found: Column, sizes: Column, lines: Column, length: Column, limits: Limits) -> Column:
    def cut(r: Column) -> Column:
        start = F.struct(r["start"].alias("st"), F.lit(0).alias("n"), F.lit(0).alias("c"), F.array().cast("array<int>").alias("stops"))

        def step(acc: Column, i: Column) -> Column:
            n, c = F.get(sizes, i), F.get(length, i)
            more = acc["c"] + F.when((acc["c"] > 0) & (c > 0), 1).otherwise(0) + c
            now = (i > acc["st"]) & ((acc["n"] + n > limits.most) | (more > limits.most_chars))
            new = F.struct(i.alias("st"), n.alias("n"), c.alias("c"), F.array_append(acc["stops"], i).alias("stops"))
            return F.when(now, new).otherwise(F.struct(acc["st"].alias("st"), (acc["n"] + n).alias("n"), more.alias("c"), acc["stops"].alias("stops")))

        return _from_stops(r["start"], F.aggregate(F.sequence(r["start"], r["stop"] - 1), start, step, lambda acc: F.array_append(acc["stops"], r["stop"])))

    def over(r: Column) -> Column:
        return ~let(_measured(r, sizes, length), lambda x: _fits(x, lines, limits))

    return F.flatten(F.transform(found, lambda r: F.when(over(r), cut(r)).otherwise(F.array(r))))


def pack(sizes: str | Column, most: int = 260) -> Column:
    """Ranges of sentences, given their words, packed in order up to a number of words; one sentence may exceed it alone."""

    @F.pandas_udf("array<int>")
    def packed(sizes: pd.Series) -> pd.Series:
        return pd.Series([None if n is None else packed_stops(n, most) for n in sizes], dtype=object)

    return _from_stops(F.lit(0), packed.asNondeterministic()(col(sizes)))


def _numbered(prefix: Column, k: Column) -> Column:
    return F.concat(prefix, F.lit("::"), F.lpad(k.cast("string"), F.greatest(F.length(k.cast("string")), F.lit(3)), "0"))


def _at(r: Column) -> tuple[Column, Column]:
    return r["start"] + 1, r["stop"] - r["start"]


def abstract_chunks(records: DataFrame, most: int = 260, title: str = "title", abstract: str = "abstract") -> DataFrame:
    """Chunks of records' abstracts, packed by words; records without an abstract give none."""
    have = {c: fold(c) if c in records.columns else F.lit("") for c in ("pmid", "doi", "journal", "year", "source_url")}
    work = records.select(*(v.alias(k) for k, v in have.items()), fold(title).alias("title"), fold(abstract).alias("abstract")).where("abstract <> ''")
    work = work.withColumns({"id": record_identifier(), "s": let(split_sentences("abstract"), lambda s: F.when(F.size(s) > 0, s).otherwise(F.array(F.col("abstract"))))})
    each = work.withColumn("__n", F.transform("s", word_count)).withColumn("__p", pack("__n", most)).select("*", F.posexplode("__p").alias("k", "r"))
    at, count = _at(F.col("r"))
    text = fold(F.array_join(F.slice("s", at, count), " "))
    url = F.when((F.col("source_url") == "") & (F.col("pmid") != ""), F.concat(F.lit("https://pubmed.ncbi.nlm.nih.gov/"), "pmid", F.lit("/"))).otherwise(F.col("source_url"))
    named = each.select(
        _numbered(F.concat("id", F.lit("::Abstract")), F.col("k") + 1).alias("chunk_id"), F.lit("pubmed_abstract").alias("source_type"), F.lit("en").alias("language"), F.lit("").alias("pmcid"),
        "pmid", "doi", "title", "journal", "year", url.alias("source_path"), url.alias("source_url"), F.lit("Abstract").alias("section"), (F.col("k") + 1).alias("chunk_index"),
        F.array(F.lit(1)).alias("source_paragraph_indices"), at.alias("sentence_start"), F.col("r.stop").alias("sentence_end"), count.alias("sentence_count"), text.alias("text"),
    )
    return named.withColumns({"word_count": word_count("text"), "char_count": F.length("text"), "semantic_boundary_scores": F.array().cast("array<double>")}).where("text <> ''")


def section_chunks(sections: DataFrame, limits: Limits = UNLIMITED, keep: tuple[str, ...] = ("pmid", "doi", "title", "journal", "year", "source_path")) -> DataFrame:
    """Chunks of sections (pmcid, section, sentences: array<struct<text, paragraph_index>>, cuts, scores and what is to be kept)."""
    article = F.coalesce(F.nullif(given("pmcid"), F.lit("")), F.lit("UNKNOWN"))
    name = F.coalesce(F.nullif(given("section"), F.lit("")), F.lit("Body"))
    work = sections.where(F.size("sentences") > 0).withColumn("__sizes", F.transform("sentences", lambda s: word_count(s["text"]))).withColumn("__r", ranges(F.size("sentences"), "cuts"))
    work = work.withColumn("__r", merge_short("__r", "__sizes", limits)).withColumn("__r", split_oversized("__r", "__sizes", limits))
    each = work.select("*", F.posexplode("__r").alias("__k", "r"))
    at, count = _at(F.col("r"))
    chosen = F.slice("sentences", at, count)
    text = fold(F.array_join(F.transform(chosen, lambda s: s["text"]), " "))
    out = each.select(
        _numbered(F.concat(article, F.lit("::"), slug(name, "section")), F.col("__k") + 1).alias("chunk_id"), article.alias("pmcid"), *(given(c).alias(c) if c in sections.columns else F.lit("").alias(c) for c in keep),
        F.lit("en").alias("language"), F.lit("pmc_full_text").alias("source_type"), name.alias("section"), (F.col("__k") + 1).alias("chunk_index"),
        F.array_sort(F.array_distinct(F.transform(chosen, lambda s: s["paragraph_index"]))).alias("source_paragraph_indices"),
        at.alias("sentence_start"), F.col("r.stop").alias("sentence_end"), count.alias("sentence_count"),
        F.transform(F.slice("scores", at, F.greatest(count - 1, F.lit(0))), lambda x: F.round(x, 6)).alias("semantic_boundary_scores"), text.alias("text"),
    )
    return out.withColumns({"word_count": word_count("text"), "char_count": F.length("text")})


def section_chunks_cjk(sections: DataFrame, limits: Limits = CJK, keep: tuple[str, ...] = ("title", "journal", "year", "doi", "source_path")) -> DataFrame:
    """Chunks of sections (document_id, section, sentences: array<struct<text, page_number, extraction_method>>, cuts, scores)."""
    document = F.coalesce(F.nullif(given("document_id"), F.lit("")), F.lit("CNKI-UNKNOWN"))
    work = sections.where(F.size("sentences") > 0).withColumns({"__n": F.transform("sentences", lambda s: unit_count(s["text"])), "__c": F.transform("sentences", lambda s: s["text"])})
    work = work.withColumn("__r", ranges(F.size("sentences"), "cuts")).withColumn("__r", merge_short("__r", "__n", limits, "__c", backward=True))
    each = work.withColumn("__r", split_oversized("__r", "__n", limits, "__c")).select("*", F.posexplode("__r").alias("__k", "r"))
    at, count = _at(F.col("r"))
    chosen = F.slice("sentences", at, count)
    pages = F.array_sort(F.array_distinct(F.transform(chosen, lambda s: s["page_number"])))
    out = each.select(
        _numbered(F.concat(document, F.lit("::"), section_key("section")), F.col("__k") + 1).alias("chunk_id"), document.alias("document_id"), *(given(c).alias(c) if c in sections.columns else F.lit("").alias(c) for c in keep),
        F.lit("zh").alias("language"), F.lit("cnki_pdf").alias("source_type"), "section", (F.col("__k") + 1).alias("chunk_index"), pages.alias("source_pages"), F.array_min(pages).alias("page_start"), F.array_max(pages).alias("page_end"),
        F.array_sort(F.array_distinct(F.filter(F.transform(chosen, lambda s: s["extraction_method"]), lambda m: m.isNotNull() & (m != "")))).alias("extraction_methods"),
        at.alias("sentence_start"), F.col("r.stop").alias("sentence_end"), count.alias("sentence_count"),
        F.transform(F.slice("scores", at, F.greatest(count - 1, F.lit(0))), lambda x: F.round(x, 6)).alias("semantic_boundary_scores"), join_lines_cjk(F.transform(chosen, lambda s: s["text"])).alias("text"),
    )
    return out.withColumns({"text_unit_count": unit_count("text"), "char_count": F.length("text")})


def section_manifest(chunks: DataFrame, *by: str) -> DataFrame:
    """Counts for each section that gave chunks."""
    return chunks.groupBy(*by).agg(F.count("*").alias("chunk_count"), F.sum("sentence_count").alias("sentence_count"), F.lit("ok").alias("status"))

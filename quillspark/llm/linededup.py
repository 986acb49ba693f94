"""Line dedup by a suffix array over sequences of line identifiers.

A document is the sequence of its lines that are not blank, and a line's identifier is a pair of 64-bit hashes.
Distributed prefix doubling ranks the suffixes of all sequences: in round h the suffixes that agree in their first
``2**h`` lines share a rank, the number of suffixes in the array before them, and the pair of ranks at i and ``i + 2**h`` gives the
next round's. Suffixes that have become unique leave the array, so rounds end with the longest repeated run. Suffixes of
one rank are a longest-common-prefix interval: a window of ``2**h`` lines that stands in all its places. Any
maximal repeated run is covered by two such windows, so the windows reveal every maximal run; all copies but
the first, by doc_id and then place, are deleted. A run counts if it has two lines or more, or one of at least ``min_chars`` characters.

The rank step groups distinct rank pairs only, so a line with very many copies is combined on the map side and not
gathered in one task.

Defined results: null texts and rows with a null doc_id are left alone; empty texts have no lines; blank lines are never deleted
and don't break a run; rows that repeat doc_id and text are one document (each gets the same result);
documents that share a doc_id but not their text are told apart; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.llm.common import clean, cut, documents, ship, sliced, written

MIN_CHARS = 20
#: Top bits of a line hash by which the first ranks are summed in two steps.
_RANK_BITS = 12
#: Ranks of 2 ** _PART_BITS suffixes are summed in one task at most, so a line that very many different lines follow is summed in parts.
_PART_BITS = 20


def _lines(texts: DataFrame) -> DataFrame:
    """(doc_id, th, i, at, long, h1, h2): each line that is not blank, its number among those, its place in the text."""
    numbered = F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(i.alias("at"), x.alias("line")))
    kept = F.filter(numbered, lambda x: x["line"].rlike("[^ \t\r]"))
    each = texts.select("doc_id", "th", F.posexplode(kept).alias("i", "x"))
    line = F.col("x.line")
    return each.select("doc_id", "th", "i", F.col("x.at").alias("at"), F.length(line).alias("chars"), F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2"))


_PLACE = ("doc_id", "th", "i")


def _first_ranks(lines: DataFrame) -> DataFrame:
    """The suffixes whose first line recurs, ranked by it."""
    groups = lines.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(F.struct(*_PLACE)).alias("first")).where("n > 1")
    groups = groups.withColumn("bucket", F.shiftright("h1", 64 - _RANK_BITS))
    totals = groups.groupBy("bucket").agg(F.sum("n").alias("total"))  # at most 2**_RANK_BITS rows
    before = totals.select("bucket", (F.sum("total").over(W.orderBy("bucket")) - F.col("total")).alias("before"))
    within = F.sum("n").over(W.partitionBy("bucket").orderBy("h1", "h2").rowsBetween(W.unboundedPreceding, -1))
    ranks = groups.join(before, "bucket").select("h1", "h2", "first", (F.col("before") + F.coalesce(within, F.lit(0))).alias("rank"))
    return lines.join(ranks, ["h1", "h2"]).select(*_PLACE, "at", "chars", "rank", (F.struct(*_PLACE) != F.col("first")).alias("later"))


def _double(active: DataFrame, k: int) -> DataFrame:
    """From ranks by the first k lines to ranks by the first 2k, for suffixes that still recur."""
    here = W.partitionBy("doc_id", "th").orderBy("i")
    pairs = active.select(*_PLACE, "at", F.col("rank").alias("r1"), F.max("rank").over(here.rangeBetween(k, k)).alias("r2"), F.max("at").over(here.rangeBetween(1, 1)).alias("next_at"))
    pairs = pairs.where("r2 is not null")
    groups = pairs.groupBy("r1", "r2").agg(F.count("*").alias("n"), F.min(F.struct(*_PLACE)).alias("first")).where("n > 1")
    groups = written(groups.withColumn("part", F.shiftright("r2", _PART_BITS)), "pairs")
    totals = groups.groupBy("r1", "part").agg(F.sum("n").alias("total"))
    earlier = W.unboundedPreceding, -1
    before = totals.select("r1", "part", F.coalesce(F.sum("total").over(W.partitionBy("r1").orderBy("part").rowsBetween(*earlier)), F.lit(0)).alias("before"))
    within = F.coalesce(F.sum("n").over(W.partitionBy("r1", "part").orderBy("r2").rowsBetween(*earlier)), F.lit(0))
    ranks = groups.join(before, ["r1", "part"]).select("r1", "r2", "first", (F.col("r1") + F.col("before") + within).alias("rank"))
    return pairs.join(ranks, ["r1", "r2"]).select(*_PLACE, "at", "next_at", "rank", (F.struct(*_PLACE) != F.col("first")).alias("later"))


def repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, th, gone, longest): the places of the lines to delete in each document, and the longest power of two that a deleted run reaches."""
    texts = documents(docs).where("doc_id is not null and text <> ''").withColumn("th", F.xxhash64("text"))
    active, k, found = cut(_first_ranks(_lines(texts))), 1, []
    found.append(active.where(f"later and chars >= {int(min_chars)}").select("doc_id", "th", F.array("at").alias("ats"), F.lit(1).alias("k")))
    first = clean(docs.sparkSession, since=1 << 60)
    while True:
        active = cut(_double(active, k))
        clean(docs.sparkSession, first)
        k *= 2
        if active.isEmpty():
            break
        # Beyond two lines a window deletes what its halves do already; it tells how far the run goes.
        ats = F.array("at", "next_at") if k == 2 else F.array().cast("array<int>")
        level = active.where("later").select("doc_id", "th", ats.alias("ats"), F.lit(k).alias("k"))
        found.append(level if k == 2 else level.distinct())
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("doc_id", "th").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ats")))).alias("gone"), F.max("k").alias("longest"))


COUNTS = ("n_lines", "n_deleted", "run_reach")


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, counts: tuple[str, str, str] = COUNTS) -> DataFrame:
    """The rows of docs with later copies of line runs deleted from text, and n_lines, n_deleted and run_reach beside them.

    n_lines and n_deleted count lines that are not blank; run_reach is the largest power of two not above the
    length of the longest run found in the document, 0 if none. All columns of docs are kept; those of the three new
    names are replaced. counts: other names for the three.
    """
    ship(docs.sparkSession)
    names = [c for c in docs.columns if c not in counts]
    base = docs.select(F.struct(*names).alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("th"))
    joined = base.join(repeated_lines(docs, min_chars), ["doc_id", "th"], "left").select("row", "gone", "longest")
    at = names.index("text")
    schema = docs.select(*names).schema
    for c in counts:
        schema = schema.add(c, "integer")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 512):
            texts, real, deleted = [], [], []
            row = batch.column(0).flatten()
            for text, gone in zip(row[at].to_pylist(), batch.column(1).to_pylist()):
                lines = text.split("\n") if text else []
                real.append(None if text is None else sum(1 for x in lines if x.strip(" \t\r")))
                deleted.append(None if text is None else len(gone or ()))
                if gone:
                    drop = set(gone)
                    text = "\n".join(x for k, x in enumerate(lines) if k not in drop)
                texts.append(text)
            row[at] = pa.array(texts, pa.string())
            reach = [x or 0 for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*row, *(pa.array(x, pa.int32()) for x in (real, deleted, reach))], [*names, *counts])

    return joined.mapInArrow(work, schema)


#: DuckDB SQL for (doc_id, text, n_lines, n_deleted) of ``documents``, given {table} and {min_chars}.
SQL = """
WITH d AS (SELECT DISTINCT doc_id, text FROM {table} WHERE doc_id IS NOT NULL AND text <> ''),
s AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d),
l AS (SELECT doc_id, text, line, pos, row_number() OVER (PARTITION BY doc_id, text ORDER BY pos) AS i,
        regexp_matches(line, '[^ \\t\\r]') AS real FROM s WHERE regexp_matches(line, '[^ \\t\\r]')),
p AS (SELECT *, lead(line) OVER w AS next, lead(pos) OVER w AS next_pos FROM l WINDOW w AS (PARTITION BY doc_id, text ORDER BY i)),
r AS (SELECT *, row_number() OVER (PARTITION BY line ORDER BY doc_id, text, i) AS n1,
        row_number() OVER (PARTITION BY line, next, next IS NULL ORDER BY doc_id, text, i) AS n2 FROM p),
gone AS (SELECT doc_id, text, pos FROM r WHERE n1 > 1 AND length(line) >= {min_chars}
  UNION SELECT doc_id, text, pos FROM r WHERE n2 > 1 AND next IS NOT NULL
  UNION SELECT doc_id, text, next_pos FROM r WHERE n2 > 1 AND next IS NOT NULL),
kept AS (SELECT s.doc_id, s.text, string_agg(s.line, chr(10) ORDER BY s.pos) AS kept FROM s
  LEFT JOIN gone g ON g.doc_id = s.doc_id AND g.text = s.text AND g.pos = s.pos WHERE g.pos IS NULL GROUP BY ALL),
n AS (SELECT l.doc_id, l.text, count(*) AS n_lines, count(g.pos) AS n_deleted FROM l
  LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.text = l.text AND g.pos = l.pos GROUP BY ALL)
SELECT t.doc_id, CASE WHEN n.n_deleted > 0 THEN coalesce(kept.kept, '') ELSE t.text END AS text,
  CASE WHEN t.text IS NULL THEN NULL ELSE coalesce(n.n_lines, 0) END::INTEGER AS n_lines,
  CASE WHEN t.text IS NULL THEN NULL ELSE coalesce(n.n_deleted, 0) END::INTEGER AS n_deleted
FROM {table} t LEFT JOIN n ON n.doc_id = t.doc_id AND n.text = t.text LEFT JOIN kept ON kept.doc_id = t.doc_id AND kept.text = t.text
"""

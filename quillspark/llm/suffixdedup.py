"""Suffix-array dedup: passages of at least ``MIN_WORDS`` words that occur in more than one document.

Anchors. In every ``WINDOW`` consecutive ``GRAM``-word windows of a text the one with the least hash is an anchor; GRAM + WINDOW - 1 =
MIN_WORDS, so any passage of MIN_WORDS words has an anchor that depends on its words alone, and all copies share
it. Anchors of one document only drop out. Each other occurrence sends its context to the anchor's bucket: as many words to both
sides as a passage of MIN_WORDS around the anchor can have.

An anchor of ``HOT`` occurrences or more, such as one in a licence that millions of documents carry, has no bucket. Such anchors are few and are sent to the documents; windows of
MIN_WORDS words over them are known by two hashes and grouped for the first and the last document that holds them, which is combined before it moves; windows of
as many occurrences are few and are sent to the documents, others join them. So no task holds a group that grows with the corpus.

Buckets. :func:`suffix_sort` sorts the suffixes that begin at the anchor, and the reversed texts before it, by merge
sort. A comparison finds the common extension of two suffixes by binary search over prefix polynomial hashes, so it
takes a logarithm of their length; extensions of neighbours are verified on the words themselves. With both
arrays and their common extensions, an occurrence lies in a repeated window l words to the left of the anchor exactly if another document's
is in the same interval of extension MIN_WORDS - l on the right and of extension l on the left.

A document's repeated windows join to spans of words. Copies after the first document, by doc_id, are removable.

Defined results: words are what white space separates; null texts and doc_ids and texts of fewer than MIN_WORDS words have no
spans; repeats within one document don't count; rows that repeat doc_id and text are one document; texts that share a
doc_id count as different documents and give a row each; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.llm.common import _powers, clean, documents, lists, map_batches, mix, release, ship, signed, sliced, texts_of, window_hashes, word_hashes, written

MIN_WORDS = 50
GRAM = 16
WINDOW = MIN_WORDS - GRAM + 1
#: Occurrences that are sorted at once; a bucket is never divided, and has fewer than HOT.
CHUNK = 8_192
HOT = 50_000
#: Windows of HOT occurrences or more that may be sent to all tasks.
MOST_SENT = 200_000
#: Frequent anchors (8 bytes each) that may be sent to all tasks. Where a corpus could have more, an anchor counts as frequent from as many occurrences on as leave no more.
MOST_ANCHORS = 4_000_000


def anchors(text: str, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Word positions and hashes of a text's anchors."""
    h = window_hashes(word_hashes(text.split()), gram)
    if len(h) < window:
        return np.zeros(0, np.int64), h[:0]
    at = np.unique(sliding_window_view(h, window).argmin(1) + np.arange(len(h) - window + 1))
    return at, h[at]


def prefixes(values: np.ndarray) -> np.ndarray:
    """Row by row, hashes of all prefixes."""
    out = np.zeros((values.shape[0], values.shape[1] + 1), np.uint64)
    np.cumsum(values * _powers(values.shape[1])[0], axis=1, out=out[:, 1:])
    return out


def extension(p: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words suffixes a and b have in common, by binary search over prefix hashes."""
    low, high = np.zeros(len(a), np.int64), np.full(len(a), p.shape[1] - 1, np.int64)
    while (open_ := low < high).any():
        mid = (low + high + 1) >> 1
        same = p[a, mid] == p[b, mid]
        low, high = np.where(open_ & same, mid, low), np.where(open_ & ~same, mid - 1, high)
    return low


def _less(values: np.ndarray, p: np.ndarray, a: np.ndarray, b: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
    n = extension(p, a, b)
    same, at = n == values.shape[1], np.minimum(n, values.shape[1] - 1)
    return np.where(same, or_equal, values[a, at] < values[b, at])


def suffix_sort(buckets: np.ndarray, values: np.ndarray, p: np.ndarray) -> np.ndarray:
    """The order of the rows of values within each bucket: bottom-up merge sort, all merges of a level side by side.

    Rows of a bucket are neighbours. An element's place in a merge is its own plus the number of the other run's that go before it.
    """
    n = len(buckets)
    order = np.arange(n)
    starts = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]])
    sizes = np.diff(np.r_[starts, n])
    start, end = np.repeat(starts, sizes), np.repeat(starts + sizes, sizes)
    width, largest = 1, int(sizes.max()) if n else 0
    while width < largest:
        slot = np.arange(n)
        run = (slot - start) // width
        left = run % 2 == 0
        other = start + np.where(left, run + 1, run - 1) * width
        low, high = np.minimum(other, end), np.minimum(other + width, end)
        first = low.copy()
        while len(todo := np.flatnonzero(low < high)):
            mid = (low[todo] + high[todo]) >> 1
            # Equal suffixes keep the order of their runs.
            before = _less(values, p, order[mid], order[todo], ~left[todo])
            low[todo] = np.where(before, mid + 1, low[todo])
            high[todo] = np.where(before, high[todo], mid)
        own = slot - start - run * width
        merged = np.empty(n, np.int64)
        merged[start + (run - run % 2) * width + own + (low - first)] = order
        order, width = merged, 2 * width
    return order


def neighbours(buckets: np.ndarray, order: np.ndarray, p: np.ndarray, words: list[list[str]]) -> np.ndarray:
    """For each place in the order the words in common with the place before, verified on the words; 0 where a bucket begins."""
    out = np.zeros(len(order), np.int64)
    inside = np.flatnonzero(np.r_[False, buckets[order][1:] == buckets[order][:-1]])
    out[inside] = extension(p, order[inside - 1], order[inside])
    for k in inside.tolist():
        a, b, m = words[order[k - 1]], words[order[k]], int(out[k])
        if a[:m] != b[:m]:  # a collision of hashes
            m = 0
            while m < min(len(a), len(b)) and a[m] == b[m]:
                m += 1
            out[k] = m
    return out


def _matrix(rows: list[list[str]], width: int, salt: int) -> np.ndarray:
    """Word hashes of each row; places beyond its end hold values that occur nowhere else."""
    lengths = np.array([len(r) for r in rows])
    filled = np.arange(width)[None, :] < lengths[:, None]
    out = mix(np.arange(filled.size, dtype=np.uint64) + np.uint64(salt)).reshape(filled.shape)
    out[filled] = word_hashes([w for r in rows for w in r])
    return out


def repeated_windows(buckets: np.ndarray, docs: np.ndarray, right: list[list[str]], left: list[list[str]], least: int = MIN_WORDS, reach: int = WINDOW - 1) -> tuple[np.ndarray, np.ndarray]:
    """(occurrences, reach + 1) flags: the window of ``least`` words from l words before the anchor also stands in another document, or in an earlier one.

    docs: numbers in the order of the documents. right: the words from the anchor on; left: those before it, nearest first.
    """
    n, ranks = len(buckets), []
    for words, width, salt in ((right, least, 1 << 40), (left, reach, 1 << 50)):
        values = _matrix(words, width, salt)
        p = prefixes(values)
        order = suffix_sort(buckets, values, p)
        ranks.append((order, neighbours(buckets, order, p, words)))
    new_bucket = np.r_[True, buckets[1:] != buckets[:-1]]

    def groups(side: int, depth: int) -> np.ndarray:
        order, common = ranks[side]
        out = np.empty(n, np.int64)
        out[order] = np.cumsum((common < depth) | new_bucket)  # new_bucket: the order keeps buckets in place
        return out

    anywhere, earlier = np.zeros((n, reach + 1), bool), np.zeros((n, reach + 1), bool)
    by_doc = np.argsort(docs, kind="stable")
    room_left, room_right = np.array([len(w) for w in left]), np.array([len(w) for w in right])
    for l in range(reach + 1):
        key = groups(0, least - l) * (n + 1) + groups(1, l)
        rows = by_doc[np.argsort(key[by_doc], kind="stable")]
        first = np.flatnonzero(np.r_[True, key[rows][1:] != key[rows][:-1]])
        sizes = np.diff(np.r_[first, n])
        d = docs[rows]
        low, high = np.repeat(d[first], sizes), np.repeat(d[first + sizes - 1], sizes)
        fits = (room_left[rows] >= l) & (room_right[rows] >= least - l)
        anywhere[rows, l], earlier[rows, l] = fits & (low != high), fits & (d != low)
    return anywhere, earlier


def _hot_spans(texts: DataFrame, frequent: np.ndarray, reach: int, hot: int) -> DataFrame:
    """(doc_id, th, start, stop, later) of the repeated windows over frequent anchors (sorted), window by window; texts have (doc_id, text, th)."""
    sent = texts.sparkSession.sparkContext.broadcast(frequent)

    def name(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        out, known = [], sent.value
        for doc_id, text, th in zip(batch.column(0).to_pylist(), texts_of(batch), batch.column(2).to_pylist()):
            h = word_hashes(text.split())
            if len(h) < MIN_WORDS:
                continue
            grams = window_hashes(h, GRAM)
            at = np.flatnonzero(known[np.minimum(np.searchsorted(known, grams), len(known) - 1)] == grams)
            if len(at):
                first, second = window_hashes(h, MIN_WORDS), window_hashes(mix(h), MIN_WORDS)
                starts = np.unique(at[:, None] - np.arange(reach + 1)[None, :])
                starts = starts[(starts >= 0) & (starts < len(first))]
                out.append((np.full(len(starts), doc_id), np.full(len(starts), th), starts.astype(np.int32), signed(first[starts]), signed(second[starts])))
        if not out:
            return None
        columns = [np.concatenate(c) for c in zip(*out)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc_id", "th", "start", "h1", "h2"])

    rows = written(map_batches(texts, name, "doc_id bigint, th bigint, start int, h1 bigint, h2 bigint", 64), "windows")
    one = F.struct("doc_id", "th")
    keys = rows.groupBy("h1", "h2").agg(F.min(one).alias("low"), F.max(one).alias("high"), F.count("*").alias("n")).where("low <> high")
    keys = written(keys.drop("high"), "repeated")
    large = keys.where(F.col("n") >= hot)
    if 0 < large.limit(MOST_SENT + 1).count() <= MOST_SENT:
        rest = rows.join(F.broadcast(large.select("h1", "h2")), ["h1", "h2"], "left_anti")
        found = rest.join(keys.where(F.col("n") < hot), ["h1", "h2"]).unionByName(rows.join(F.broadcast(large), ["h1", "h2"]))
    else:
        found = rows.join(keys, ["h1", "h2"])
    kinds = F.when(one == F.col("low"), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))
    return found.select("doc_id", "th", "start", (F.col("start") + MIN_WORDS).alias("stop"), F.explode(kinds).alias("later"))


_CONTEXT = "anchor bigint, doc_id bigint, th bigint, at int, left string, right string"


def repeated_spans(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """(doc_id, repeated, removable, n_words): spans of words, from start to before end, of every document that has a repeated passage."""
    spark, reach = docs.sparkSession, WINDOW - 1
    texts = documents(docs).where("doc_id is not null and text <> ''").withColumn("th", F.xxhash64("text"))

    def find(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [anchors(t) for t in texts_of(batch)]
        sizes = [len(a) for a, _ in found]
        at = lists(np.concatenate([a for a, _ in found]).astype(np.int32), sizes, pa.int32())
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), at, lists(signed(np.concatenate([h for _, h in found])), sizes, pa.int64())], ["doc_id", "th", "at", "anchor"])

    found = map_batches(texts, find, "doc_id bigint, th bigint, at array<int>, anchor array<bigint>")
    each = found.select("doc_id", "th", F.explode(F.arrays_zip("at", "anchor")).alias("x")).select("doc_id", "th", "x.at", "x.anchor")
    first = clean(spark, since=1 << 60)
    each = written(each, "occurrences")
    # Frequent anchors are told by counts that tasks combine before they move, so no task gets all occurrences of one.
    hot = max(hot, -(-each.count() // MOST_ANCHORS))
    often = written(each.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") >= hot).select("anchor"), "frequent")  # at most MOST_ANCHORS
    frequent = np.sort(often.toArrow()["anchor"].to_numpy().view(np.uint64))
    rare = each.join(F.broadcast(often), "anchor", "left_anti") if len(frequent) else each
    # A window over the anchor's occurrences: a join with the shared anchors would move all of them twice.
    one, same = F.struct("doc_id", "th"), W.partitionBy("anchor")
    shared = rare.select("*", F.min(one).over(same).alias("low"), F.max(one).over(same).alias("high")).where("low <> high")
    wanted = written(shared.groupBy("doc_id", "th").agg(F.collect_set(F.struct("at", "anchor")).alias("anchors")), "anchors")
    clean(spark, first, keep=1)
    release(spark)

    def contexts(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for doc_id, text, th, chosen in zip(batch.column(0).to_pylist(), texts_of(batch), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            words = text.split()
            for x in chosen:
                at = x["at"]
                rows.append((x["anchor"], doc_id, th, at, " ".join(words[max(0, at - reach) : at]), " ".join(words[at : at + MIN_WORDS])))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string()))], ["anchor", "doc_id", "th", "at", "left", "right"])

    joined = texts.join(wanted, ["doc_id", "th"]).select("doc_id", "text", "th", "anchors")
    placed = map_batches(joined, contexts, _CONTEXT, 64).repartition("anchor").sortWithinPartitions("anchor", "doc_id", "th", "at")

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, whole = [], 0  # rows, and how many of them are of buckets that have ended
        for batch in sliced(batches, 4096):
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and row[0] != held[-1][0]:
                    whole = len(held)
                    if whole >= CHUNK:
                        yield from windows(held)
                        held = []
                held.append(row)
        if held:
            yield from windows(held)

    def windows(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        anchor, doc, th, at, left, right = zip(*rows)
        number = {k: i for i, k in enumerate(sorted(set(zip(doc, th))))}
        docs_ = np.array([number[k] for k in zip(doc, th)])
        anywhere, earlier = repeated_windows(np.array(anchor), docs_, [r.split(" ") for r in right], [x.split(" ")[::-1] if x else [] for x in left])
        doc, th, at = np.array(doc), np.array(th), np.array(at)
        for flags, kind in ((anywhere, False), (earlier, True)):
            padded = np.zeros((len(flags), flags.shape[1] + 2), bool)
            padded[:, 1:-1] = flags
            edge = padded[:, 1:] != padded[:, :-1]
            row, l = np.nonzero(edge)
            row, near, far = row[::2], l[::2], l[1::2] - 1  # runs of l: spans from the farthest start to the nearest one's end
            if len(row):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc[row]), pa.array(th[row]), pa.array((at[row] - far).astype(np.int32)), pa.array((at[row] - near + MIN_WORDS).astype(np.int32)), pa.array(np.full(len(row), kind))],
                    ["doc_id", "th", "start", "stop", "later"],
                )

    ship(docs.sparkSession)
    spans = placed.mapInArrow(settle, "doc_id bigint, th bigint, start int, stop int, later boolean")
    if len(frequent):
        spans = spans.unionByName(_hot_spans(texts, frequent, reach, hot))
    spans = spans.groupBy("doc_id", "th", "later", "start").agg(F.max("stop").alias("stop")).repartition("doc_id", "th").sortWithinPartitions("doc_id", "th", "later", "start")
    span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))

    def join_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, both, out = None, ([], []), []
        for batch in sliced(batches, 8192):
            for doc, th, later, start, stop in zip(*(c.to_pylist() for c in batch.columns)):
                if (doc, th) != key:
                    if key:
                        out.append((key[0], *both))
                    key, both = (doc, th), ([], [])
                spans_ = both[later]
                if spans_ and start <= spans_[-1]["stop"]:
                    spans_[-1]["stop"] = max(stop, spans_[-1]["stop"])
                else:
                    spans_.append({"start": start, "stop": stop})
            if len(out) > 1024:
                yield packed(out)
                out = []
        if key:
            out.append((key[0], *both))
        if out:
            yield packed(out)

    def packed(out: list[tuple]) -> pa.RecordBatch:
        ids, repeated, removable = zip(*out)
        total = [sum(s["stop"] - s["start"] for s in r) for r in repeated]
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(repeated, span), pa.array(removable, span), pa.array(total, pa.int32())], ["doc_id", "repeated", "removable", "n_words"])

    return spans.mapInArrow(join_spans, "doc_id bigint, repeated array<struct<start:int,stop:int>>, removable array<struct<start:int,stop:int>>, n_words int")


#: DuckDB SQL for :func:`repeated_spans` of ``documents`` with doc_ids of their own, the spans' ends as lists.
SQL = """
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS w FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
x AS (SELECT doc_id, CAST(s - 1 AS INTEGER) AS start, md5(array_to_string(w[s:s + 49], ' ')) AS h FROM d, unnest(range(1, len(w) - 48)) AS u(s) WHERE len(w) >= 50),
k AS (SELECT h, min(doc_id) AS first FROM x GROUP BY h HAVING count(DISTINCT doc_id) > 1),
r AS (SELECT doc_id, start, 'repeated' AS kind FROM x JOIN k USING (h) UNION ALL SELECT doc_id, start, 'removable' FROM x JOIN k USING (h) WHERE doc_id > first),
g AS (SELECT *, start - coalesce(lag(start) OVER (PARTITION BY doc_id, kind ORDER BY start), -100) > 50 AS fresh FROM r),
n AS (SELECT doc_id, kind, start, count(*) FILTER (WHERE fresh) OVER (PARTITION BY doc_id, kind ORDER BY start) AS span FROM g),
s AS (SELECT doc_id, kind, min(start) AS start, CAST(max(start) + 50 AS INTEGER) AS stop FROM n GROUP BY doc_id, kind, span)
SELECT doc_id, list(start ORDER BY start) FILTER (WHERE kind = 'repeated') AS repeated_start, list(stop ORDER BY start) FILTER (WHERE kind = 'repeated') AS repeated_stop,
  coalesce(list(start ORDER BY start) FILTER (WHERE kind = 'removable'), []) AS removable_start, coalesce(list(stop ORDER BY start) FILTER (WHERE kind = 'removable'), []) AS removable_stop,
  CAST(sum(stop - start) FILTER (WHERE kind = 'repeated') AS INTEGER) AS n_words FROM s GROUP BY doc_id
"""

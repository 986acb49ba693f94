"""Exact dedup by content-defined chunk recipes.

A gear hash over the last 32 bytes cuts a text into chunks of about ``2**AVERAGE_BITS`` bytes, so equal texts have equal
chunks wherever they lie. A document's recipe is its ordered list of chunk hashes (128 bits each). Recipes are grouped
by a digest of 16 bytes and a length, which is all that moves for a document that has no copy. Only documents
whose digest recurs send their chunks, and of equal chunks each task sends one: chunks are deduplicated to verified
identifiers by hash and content, so two contents with one hash get two identifiers. Copies are documents whose
ordered identifier lists are equal.

Defined results: documents with a null doc_id or null text are no copies of anything; empty texts are copies of each other
(an empty recipe); repeated rows are copies under the same doc_id; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import documents, map_batches, texts_of, written

AVERAGE_BITS = 11
LEAST, MOST = 512, 16_384
#: Documents of a group from which it is joined by sending its recipe, so that the group needs no task of its own; and how many such groups may be sent.
HOT, MOST_SENT = 100_000, 2_000
_GEAR = np.random.default_rng(20240611).integers(0, 1 << 32, 256, dtype=np.uint64).astype(np.uint32)


def cuts(data: bytes, average_bits: int = AVERAGE_BITS, least: int = LEAST, most: int = MOST) -> list[int]:
    """Ends of the chunks of some bytes: where the gear hash has its top bits zero, at least ``least`` and at most ``most`` bytes apart."""
    n = len(data)
    if n <= least:
        return [n] if n else []
    h = _GEAR[np.frombuffer(data, np.uint8)]
    for step in (1, 2, 4, 8, 16):  # h[i] = sum of gear[i - j] << j for j < 2 * step
        h[step:] += h[:-step] << np.uint32(step)
    marks = np.flatnonzero(h >> np.uint32(32 - average_bits) == 0) + 1
    out, last = [], 0
    for mark in marks.tolist():
        if mark - last < least:
            continue
        while mark - last > most:
            last += most
            out.append(last)
        if mark - last >= least and mark < n:
            out.append(mark)
            last = mark
    while n - last > most:
        last += most
        out.append(last)
    out.append(n)
    return out


def _hash(chunk: bytes, bits: int) -> bytes:
    return (xxhash.xxh3_128_intdigest(chunk) & ((1 << bits) - 1)).to_bytes(16, "big")


def _recipe(text: str, bits: int) -> tuple[list[bytes], list[bytes]]:
    data, last, chunks = text.encode("utf-8", "surrogatepass"), 0, []
    for end in cuts(data):
        chunks.append(data[last:end])
        last = end
    return chunks, [_hash(c, bits) for c in chunks]


def exact_copies(docs: DataFrame, hash_bits: int = 128, hot: int = HOT) -> DataFrame:
    """(doc_id, first_doc_id, n_copies): a row for each row of docs whose text occurs more than once; first_doc_id is the group's least."""

    def recipes(batch: pa.RecordBatch) -> pa.RecordBatch:
        digests, sizes = [], []
        for text in texts_of(batch):
            hashes = _recipe(text, hash_bits)[1]
            digests.append(_hash(b"".join(hashes), hash_bits))
            sizes.append(len(hashes))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary()), pa.array(sizes, pa.int32())], ["doc_id", "digest", "chunks"])

    def pieces(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for row, text in zip(batch.column(0).to_pylist(), texts_of(batch)):
            rows += [(row, k, h, c) for k, (c, h) in enumerate(zip(*_recipe(text, hash_bits)))]
        columns = list(zip(*rows)) if rows else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.binary(), pa.binary()))], ["row", "k", "hash", "chunk"])

    texts = documents(docs).where("doc_id is not null and text is not null")
    found = map_batches(texts, recipes, "doc_id bigint, digest binary, chunks int")
    again = found.groupBy("digest", "chunks").agg(F.count("*").alias("n")).where("n > 1").select("digest", "chunks")
    ids = found.join(again, ["digest", "chunks"], "left_semi").select("doc_id").distinct()
    # A row's key names its doc_id and text; rows that repeat both are one document with a count.
    candidates = written(texts.join(ids, "doc_id", "left_semi"), "exact").withColumn("row", F.concat_ws(":", "doc_id", F.xxhash64("text"), F.crc32("text"), F.length("text")))
    chunks = map_batches(candidates.select("row", "text"), pieces, "row string, k int, hash binary, chunk binary")
    contents = chunks.groupBy("hash", "chunk").agg(F.count("*").alias("n"))
    # Hashes that stand for more than one content; none unless 128 bits collide. Their chunks are told apart by a second look at the content.
    clashing = contents.groupBy("hash").agg(F.count("*").alias("contents"), F.array_sort(F.collect_set(F.sha2("chunk", 512))).alias("known")).where("contents > 1").select("hash", "known")
    named = chunks.join(clashing, "hash", "left").select("row", "k", F.struct("hash", F.when(F.col("known").isNotNull(), F.array_position("known", F.sha2("chunk", 512))).otherwise(F.lit(1)).alias("rank")).alias("id"))
    lists = named.groupBy("row").agg(F.transform(F.array_sort(F.collect_set(F.struct("k", "id"))), lambda x: x["id"]).alias("recipe"))
    rows = candidates.groupBy("row", "doc_id").agg(F.count("*").alias("times"))
    # A member of a group is a row of its own, so a group of any size is never held in one.
    empty = F.array().cast("array<struct<hash:binary,rank:bigint>>")
    members = written(rows.join(lists, "row", "left").select("doc_id", "times", F.coalesce("recipe", empty).alias("recipe")), "recipes")
    groups = written(members.groupBy("recipe").agg(F.sum("times").alias("n_copies"), F.min("doc_id").alias("first_doc_id"), F.count("*").alias("n_rows")).where("n_copies > 1"), "copies")
    large = groups.where(F.col("n_rows") >= hot).drop("n_rows")
    n_large = large.limit(MOST_SENT + 1).count()  # no more than rows / hot; beyond MOST_SENT they are joined like the others
    if 0 < n_large <= MOST_SENT:
        each = members.join(groups.where(F.col("n_rows") < hot).drop("n_rows"), "recipe").unionByName(members.join(F.broadcast(large), "recipe"))
    else:
        each = members.join(groups.drop("n_rows"), "recipe")
    # Repeated rows come back as often as they were, a thousand at a time.
    thousands = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("times") - 1) / 1000)))
    again = each.select("doc_id", "first_doc_id", "n_copies", "times", thousands.alias("k"))
    return again.select("doc_id", "first_doc_id", "n_copies", F.explode(F.sequence(F.lit(1).cast("bigint"), F.least(F.lit(1000).cast("bigint"), F.col("times") - 1000 * F.col("k")))).alias("_")).drop("_")


SQL = """
WITH t AS (SELECT doc_id, text FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
g AS (SELECT text, min(doc_id) AS first_doc_id, count(*) AS n_copies FROM t GROUP BY text HAVING count(*) > 1)
SELECT t.doc_id, g.first_doc_id, g.n_copies FROM t JOIN g ON t.text = g.text
"""

"""N-gram Jaccard join: documents whose sets of word n-grams have a Jaccard index of at least ``threshold``, exactly.

Sets are sets of n-gram hashes (of 40 bits and as many more as the parts of the hash space have: see :func:`hash_bits`). Documents with equal sets are one class, and classes are joined, so copies are never expanded into pairs.
The result is a row for each document that has a link: its class of connected documents and its number of links.

Candidates are found by prefixes, without loss. An n-gram that only one set has is in no overlap, so only shared n-grams count, the rarest
first. Sets that reach the threshold overlap in at least ``threshold`` times either one's size, so both hold one of the
same n-grams among all but the last ``threshold * size - 1`` of their shared ones. Each of these n-grams names a tile. Which
n-grams are shared is found without a row for each: tasks pack the n-grams of many documents into one block for each part of the hash space, parts are
counted on their own, and the places and frequencies of shared n-grams go back to where the block came from.

Within a tile sets lie in order of size, so that a set meets only those of its size band, up to ``1 / threshold`` times its own. A tile of more
than ``BLOCK`` sets is divided into blocks, and each pair of blocks is met on its own, so no task holds more than two blocks of a tile.
What tiles find is not pairs but the least set that each set meets: its home. Sets of one home are a group (of at most about ``BLOCK``: larger ones
are divided), and a cell is a pair of groups with the sets that met over it. So arrays travel once for each group that a set meets,
which for a cluster of near copies is hardly more than one, and each pair has one cell.

In a cell every pair of fitting sizes goes through the bitmap bound: a set's signature has the parity of its hashes at each of as many bits as its band
calls for, the bits in which two signatures differ are no more than the elements in which the sets differ, so
(|A| + |B| - differing bits) / 2 bounds the overlap from above. Pairs that could still reach the threshold are settled by
intersecting the sorted arrays. A cell gives the links of each set and a forest of its linked sets, not its pairs.

Defined results: null doc_ids, null texts and texts without words link with nothing; a text of fewer words than ``n`` is one n-gram of all its
words; rows that repeat a doc_id and a set are one document; texts that share a doc_id but differ are documents of their own, each with a row;
empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import cut, documents, release, ship, sliced, texts_of, unused, window_hashes, word_hashes, written

N = 3
THRESHOLD = 0.5
#: N-grams that a task packs into blocks at once.
AT_ONCE = 1 << 19
#: Sets of one tile that are met at once; a larger tile is divided.
BLOCK = 2048
#: N-grams before a tile's own that travel with a set, to tell pairs of earlier tiles at once.
FIRST = 4


def hash_bits(parts: int) -> int:
    """Bits of an n-gram's hash: five bytes travel, and the part of the hash space stands for the rest."""
    return 40 + max(0, parts.bit_length() - 1)


def shingles(text: str, n: int = N, bits: int = 48) -> np.ndarray:
    """The sorted distinct hashes of a text's n-grams of lower-case words."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(window_hashes(word_hashes(words), min(n, len(words))) >> np.uint64(64 - bits))


def _pack(x: np.ndarray, size: int) -> bytes:
    """The low bytes of some values."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].tobytes()


def _unpack(data: bytes, size: int) -> np.ndarray:
    out = np.zeros((len(data) // size, 8), np.uint8)
    out[:, :size] = np.frombuffer(data, np.uint8).reshape(-1, size)
    return out.view("<u8").reshape(-1)


def _gaps(places: np.ndarray) -> bytes:
    """Ascending places as differences: a byte each and four more for large ones, or as many as the largest needs."""
    gaps = np.diff(places, prepend=0)
    large = gaps[gaps > 254]
    if len(large) * 4 < len(gaps) and len(gaps):
        return b"\0" + np.minimum(gaps, 255).astype(np.uint8).tobytes() + large.astype("<u4").tobytes()
    kind = 2 if not len(gaps) or gaps.max() < 65_536 else 4
    return bytes([kind]) + gaps.astype(f"<u{kind}").tobytes()


def _places(data: bytes, n: int) -> np.ndarray:
    if data[0]:
        return np.cumsum(np.frombuffer(data, f"<u{data[0]}", n, 1).astype(np.int64))
    gaps = np.frombuffer(data, np.uint8, n, 1).astype(np.int64)
    gaps[gaps == 255] = np.frombuffer(data, "<u4", -1, 1 + n)
    return np.cumsum(gaps)


def frequency_code(df: np.ndarray) -> np.ndarray:
    """A byte that orders n-grams by frequency: eight steps for each doubling."""
    return np.minimum(255, np.floor(8 * np.log2(df))).astype(np.uint8)


_HOT = int(8 * np.log2(BLOCK))


def needed(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """The least overlap of sets of these sizes that reach the threshold."""
    return np.ceil(threshold / (1 + threshold) * (a + b) - 1e-9)


def band(sizes: np.ndarray, threshold: float) -> np.ndarray:
    return np.floor(np.log(np.maximum(sizes, 1)) / -np.log(threshold) + 1e-9).astype(np.int64)


def _bits(low: float) -> int:
    return int(max(64, 2 ** np.ceil(np.log2(2 * max(low, 1)))))


def bitmaps(flat: np.ndarray, row: np.ndarray, n: int, bits: int) -> np.ndarray:
    """For each of n sets the parities of its hashes at each bit, as 64-bit words; flat holds hashes, row whose they are."""
    counts = np.bincount(row * bits + (flat & np.uint64(bits - 1)).astype(np.int64), minlength=n * bits) & 1
    return np.packbits(counts.astype(np.uint8)).view(np.uint64).reshape(n, bits // 64)


def folded(signatures: np.ndarray, bits: int) -> np.ndarray:
    """Signatures of more bits as some of fewer: parities add up."""
    return np.bitwise_xor.reduce(signatures.reshape(len(signatures), -1, bits // 64), axis=1)


def _packed(docs: list[tuple], parts: int, uid: int) -> Iterator[tuple]:
    """Blocks of many documents' n-grams by part of the hash space, and one that tells how to put the answers together."""
    sets: dict[bytes, int] = {}
    arrays, ids = [], []
    of_doc = np.zeros(len(docs), np.int32)
    for k, (_, _, grams) in enumerate(docs):
        digest = xxhash.xxh3_128_digest(grams.tobytes())
        if digest not in sets:
            sets[digest] = len(sets)
            arrays.append(grams)
            ids.append(digest)
        of_doc[k] = sets[digest]
    flat, sizes = np.concatenate(arrays), np.array([len(a) for a in arrays], np.int32)
    owner = np.repeat(np.arange(len(arrays), dtype=np.int32), sizes)
    _, first, inverse, counts = np.unique(flat, return_index=True, return_inverse=True, return_counts=True)
    fresh = np.zeros(len(flat), bool)
    fresh[first] = True
    place = np.cumsum(fresh) - 1
    grams, times = flat[fresh], counts[inverse[fresh]]
    part = (grams % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    begins = np.flatnonzero(np.r_[True, part[order][1:] != part[order][:-1]])
    for a, b in zip(begins, np.r_[begins[1:], len(order)]):
        at = order[a:b]
        many = np.flatnonzero(times[at] > 1)
        yield int(part[at[0]]), uid, 1, [_pack(grams[at] // np.uint64(parts), 5), _gaps(at), many.astype("<u4").tobytes(), times[at[many]].astype("<u4").tobytes()]
    again = np.flatnonzero(~fresh)
    home = [
        np.array([d for d, _, _ in docs], "<i8"), np.array([h for _, h, _ in docs], "<i8"), of_doc.astype("<i4"), sizes.astype("<i4"),
        np.bincount(owner[fresh], minlength=len(arrays)).astype("<i4"), owner[again].astype("<i4"), place[first[inverse[again]]].astype("<i4"), np.array([len(begins)], "<i4"),
    ]
    yield uid % parts, uid, 0, [b"".join(ids), *(x.tobytes() for x in home)]


_BLOCKS = pa.schema([("part", pa.int64()), ("uid", pa.int64()), ("kind", pa.int32()), ("data", pa.list_(pa.binary()))])
_BLOCKS_DDL = "part bigint, uid bigint, kind int, data array<binary>"


def _blocks(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _BLOCKS)], schema=_BLOCKS)


def _keyed(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[list[dict]]:
    """Rows that are neighbours with one value of the column."""
    held: list[dict] = []
    for batch in sliced(batches, 64):
        for row in batch.to_pylist():
            if held and row[column] != held[0][column]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _counted(rows: list[dict]) -> Iterator[tuple]:
    """What a part's n-grams that stand in more than one set answer to each block; other rows go on."""
    blocks = [r for r in rows if r["kind"] == 1]
    yield from ((r["part"], r["uid"], 0, r["data"]) for r in rows if r["kind"] == 0)
    if not blocks:
        return
    grams = [_unpack(r["data"][0], 5) for r in blocks]
    sizes = np.array([len(g) for g in grams])
    times = np.ones(sizes.sum(), np.int64)
    for at, r in zip(np.cumsum(sizes) - sizes, blocks):
        times[at + np.frombuffer(r["data"][2], "<u4").astype(np.int64)] = np.frombuffer(r["data"][3], "<u4")
    _, inverse = np.unique(np.concatenate(grams), return_inverse=True)
    df = np.bincount(inverse, times)[inverse]
    for own, n, r, g in zip(np.split(df, np.cumsum(sizes)[:-1]), sizes, blocks, grams):
        shared = np.flatnonzero(own > 1)
        yield r["part"], r["uid"], 1, [_pack(g[shared], 5), _gaps(_places(r["data"][1], int(n))[shared]), frequency_code(own[shared]).tobytes()]


_SETS = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("th", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("size", pa.int32()), ("prefix", pa.int32()), ("grams", pa.binary()), ("codes", pa.binary())])
_SETS_DDL = "kind int, doc_id bigint, th bigint, d1 bigint, d2 bigint, size int, prefix int, grams binary, codes binary"


def _placed(rows: list[dict], threshold: float, parts: int) -> pa.RecordBatch:
    """The documents of one block with their sets, and the sets that may reach the threshold with their shared n-grams, the rarest first."""
    home = [r["data"] for r in rows if r["kind"] == 0]
    answers = [(r["part"], *r["data"]) for r in rows if r["kind"] == 1]
    ids = np.frombuffer(home[0][0], ">i8").reshape(-1, 2)
    doc_ids, ths = (np.frombuffer(x, "<i8") for x in home[0][1:3])
    of_doc, sizes, fresh, again, again_at, expected = (np.frombuffer(x, "<i4").astype(np.int64) for x in home[0][3:])
    if len(home) != 1 or len(answers) != expected[0]:
        raise RuntimeError("blocks of documents were made anew in another order; run the stage again")
    grams = np.concatenate([_unpack(a[1], 5) * np.uint64(parts) + np.uint64(a[0]) for a in answers])
    at = np.concatenate([_places(a[2], len(a[3])) for a in answers])
    codes = np.concatenate([np.frombuffer(a[3], np.uint8) for a in answers])
    order = np.argsort(at)
    grams, at, codes = grams[order], at[order], codes[order]
    owner = np.searchsorted(np.cumsum(fresh), at, side="right")
    more = np.searchsorted(at, again_at)
    owner, grams, codes = np.concatenate([owner, again]), np.concatenate([grams, grams[more]]), np.concatenate([codes, codes[more]])
    order = np.lexsort((grams, codes, owner))
    owner, grams, codes = owner[order], grams[order], codes[order]
    shared = np.bincount(owner, minlength=len(sizes))
    least = np.maximum(1, np.ceil(threshold * sizes - 1e-9)).astype(np.int64)
    ends, out = np.cumsum(shared), []
    for k in np.flatnonzero(shared >= least).tolist():
        a, b, prefix = ends[k] - shared[k], ends[k], int(shared[k] - least[k] + 1)
        out.append((1, None, None, int(ids[k, 0]), int(ids[k, 1]), int(sizes[k]), prefix, grams[a:b].tobytes(), codes[a : a + prefix].tobytes()))
    found = list(zip(*out)) if out else [[]] * len(_SETS)
    n, m = len(doc_ids), len(out)
    columns = [
        pa.array([0] * n + [1] * m, pa.int32()), pa.array([*doc_ids.tolist(), *found[1]], pa.int64()), pa.array([*ths.tolist(), *found[2]], pa.int64()), pa.array([*ids[of_doc, 0].tolist(), *found[3]], pa.int64()),
        pa.array([*ids[of_doc, 1].tolist(), *found[4]], pa.int64()), pa.array([*sizes[of_doc].tolist(), *found[5]], pa.int32()), *(pa.array([*[None] * n, *found[k]], _SETS.field(k).type) for k in (6, 7, 8)),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=_SETS)


def shared_grams(docs: DataFrame, n: int = N, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(doc_id, th, d1, d2) of all texts, and the sets that may be linked: (set, d1, d2, size, prefix, grams, codes, copies)."""
    spark = docs.sparkSession
    ship(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = hash_bits(parts)
    texts = documents(docs).where("doc_id is not null and text <> ''").withColumn("th", F.xxhash64("text"))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, turn = [], 0, 0

        def packed() -> pa.RecordBatch:
            # Blocks are known by what they hold, so one that is made again has the same name only if it is the same.
            known = xxhash.xxh3_64(f"{TaskContext.get().partitionId()} {turn}")
            for doc_id, th, grams in held:
                known.update(np.array([doc_id, th, len(grams)], np.int64).tobytes())
            return _blocks(list(_packed(held, parts, known.intdigest() >> 1)))

        for batch in sliced(batches):
            for doc_id, th, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), texts_of(batch)):
                grams = shingles(text, n, bits)
                if len(grams):
                    held.append((doc_id, th, grams))
                    size += len(grams)
                if size >= AT_ONCE:
                    yield packed()
                    held, size, turn = [], 0, turn + 1
        if held:
            yield packed()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _keyed(batches, "part"):
            yield _blocks(list(_counted(rows)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _keyed(batches, "uid"):
            yield _placed(rows, threshold, parts)

    blocks = texts.mapInArrow(spread, _BLOCKS_DDL).repartition("part").sortWithinPartitions("part")
    answers = blocks.mapInArrow(count, _BLOCKS_DDL).repartition("uid").sortWithinPartitions("uid")
    found = written(answers.mapInArrow(place, _SETS_DDL), "grams")
    del blocks, answers
    release(spark)
    hopeful = found.where("kind = 1").groupBy("d1", "d2").agg(*(F.first(c).alias(c) for c in ("size", "prefix", "grams", "codes")))
    copies = members_of(found).groupBy("d1", "d2").agg(F.count("*").alias("copies"))
    sets = written(hopeful.join(copies, ["d1", "d2"]).withColumn("set", F.monotonically_increasing_id()), "sets")
    return found.where("kind = 0").select("doc_id", "th", "d1", "d2"), sets


def members_of(texts: DataFrame) -> DataFrame:
    """(doc_id, d1, d2): the documents; rows that repeat both doc_id and set are one."""
    return texts.where("doc_id is not null").select("doc_id", "d1", "d2").distinct()


_TILES = pa.schema([("tile", pa.int64()), ("set", pa.int64()), ("size", pa.int32()), ("rest", pa.int32()), ("pos", pa.int32()), ("firsts", pa.binary())])
_TILES_DDL = "tile bigint, set bigint, size int, rest int, pos int, firsts binary"


def _in_tiles(sets: DataFrame, hot: bool) -> DataFrame:
    """A row for each n-gram of each prefix: frequent ones, or the others. rest: shared n-grams after it; firsts: the first of the set's prefix."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 64):
            out = []
            for set_, size, grams, codes in zip(*(c.to_pylist() for c in batch.columns)):
                pos = np.flatnonzero((np.frombuffer(codes, np.uint8) >= _HOT) == hot)
                out.append((set_, size, len(grams) // 8 - 1 - pos, pos, np.frombuffer(grams, "<i8", len(codes))[pos], grams[: 8 * FIRST]))
            counts = [len(x[3]) for x in out]
            if sum(counts):
                times = lambda k, kind: np.repeat(np.array([x[k] for x in out], kind), counts)
                tile, rest, pos = (np.concatenate([x[k] for x in out]) for k in (4, 2, 3))
                firsts = pa.array([x[5] for x in out], pa.binary()).take(pa.array(np.repeat(np.arange(len(out)), counts)))
                yield pa.RecordBatch.from_arrays([pa.array(tile), pa.array(times(0, np.int64)), pa.array(times(1, np.int32)), pa.array(rest.astype(np.int32)), pa.array(pos.astype(np.int32)), firsts], schema=_TILES)

    return sets.select("set", "size", "grams", "codes").mapInArrow(explode, _TILES_DDL)


def _in_cells(sets: DataFrame) -> DataFrame:
    """Rows of tiles in cells (tile, x, y): a tile of more than BLOCK sets has one for each pair of its blocks."""
    rows = _in_tiles(sets, True)
    blocks = rows.groupBy("tile").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    hot = rows.join(blocks, "tile").withColumn("side", F.pmod(F.xxhash64("set"), "blocks").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    hot = hot.withColumns({"x": F.least("side", "other"), "y": F.greatest("side", "other")}).drop("blocks", "other")
    cold = _in_tiles(sets, False).withColumns({"side": F.lit(0), "x": F.lit(0), "y": F.lit(0)})
    return cold.unionByName(hot)


_TILE = ("tile", "x", "y")
_CELL = ("home", "part", "other_home", "other_part")


def _cells(batches: Iterator[pa.RecordBatch], names: tuple[str, ...], most: int) -> Iterator[dict]:
    """Columns of whole cells, rows that are neighbours with equal values of ``names``, at least ``most`` bytes at a time."""
    held: list[pa.RecordBatch] = []
    for part in sliced(batches, 4096):
        held.append(part)
        if sum(b.nbytes for b in held) >= most:
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            key = _key(table, names)
            others = np.flatnonzero(np.any(key != key[-1], axis=1))
            if len(others):
                yield _columns(table.slice(0, int(others[-1]) + 1), names)
                table = table.slice(int(others[-1]) + 1)
            held = [table]
    if held:
        yield _columns(pa.Table.from_batches(held).combine_chunks().to_batches()[0], names)


def _key(batch: pa.RecordBatch, names: tuple[str, ...]) -> np.ndarray:
    return np.stack([batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in names], 1)


def _columns(batch: pa.RecordBatch, names: tuple[str, ...]) -> dict:
    out = {f.name: c.to_pylist() if pa.types.is_binary(f.type) else c.to_numpy(zero_copy_only=False).astype(np.int64) for f, c in zip(batch.schema, batch.columns)}
    key = _key(batch, names)
    begins = np.flatnonzero(np.r_[True, np.any(key[1:] != key[:-1], axis=1)])
    out["end"] = np.repeat(np.r_[begins[1:], len(key)], np.diff(np.r_[begins, len(key)]))
    return out


def fitting(c: dict, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs, all cells side by side, that fit in size. Rows of a cell are in order of size; a cell of two sides has pairs across only."""
    i, step = np.arange(len(c["end"])), 1
    most = c["size"] / threshold + 1e-9
    while True:
        i = i[i + step < c["end"][i]]
        i = i[c["size"][i + step] <= most[i]]
        if not len(i):
            return
        across = c["one"][i] | (c["side"][i] != c["side"][i + step])
        if across.any():
            yield i[across], i[across] + step
        step += 1


def met(c: dict, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The fitting pairs of some tiles that can still overlap enough and aren't known to share an earlier tile."""
    firsts = np.zeros((len(c["end"]), FIRST), np.int64)
    lengths = np.array([len(f) // 8 for f in c["firsts"]])
    firsts[np.arange(FIRST)[None, :] < lengths[:, None]] = np.frombuffer(b"".join(c["firsts"]), "<i8")
    firsts[np.arange(FIRST)[None, :] >= c["pos"][:, None]] = -1  # only n-grams before the tile's own are of earlier tiles
    for a, b in fitting(c, threshold):
        ok = 1 + np.minimum(c["rest"][a], c["rest"][b]) >= needed(c["size"][a], c["size"][b], threshold)
        a, b = a[ok], b[ok]
        for k in range(FIRST):
            for m in range(FIRST):
                fa = firsts[a, k]
                new = (fa != firsts[b, m]) | (fa < 0)
                if not new.all():
                    a, b = a[new], b[new]
                    fa = firsts[a, k]
        if len(a):
            yield a, b


def settled(c: dict, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(a, b, index): the pairs of some cells that reach the threshold."""
    grams = [np.sort(np.frombuffer(g, "<u8")) for g in c["grams"]]
    count, sizes = np.array([len(g) for g in grams]), c["size"]
    flat, row = np.concatenate(grams), np.repeat(np.arange(len(grams)), count)
    bands = band(sizes, threshold)
    signatures: dict[tuple[int, int], np.ndarray] = {}
    slot = np.zeros(len(sizes), np.int64)
    for b in np.unique(bands).tolist():
        of = np.flatnonzero(bands == b)
        slot[of] = np.arange(len(of))
        inside = bands[row] == b
        bits, below = _bits(threshold ** -float(b)), _bits(threshold ** -float(b - 1))
        signatures[b, b] = bitmaps(flat[inside], slot[row[inside]], len(of), bits)
        signatures[b, b - 1] = folded(signatures[b, b], below)
    hopeful = []
    for i, j in fitting(c, threshold):
        for b in np.unique(bands[i]).tolist():
            for up in (b, b + 1):
                of = np.flatnonzero((bands[i] == b) & (bands[j] == up))
                if len(of):
                    a, d = i[of], j[of]
                    apart = np.bitwise_count(signatures[b, b][slot[a]] ^ signatures[up, b][slot[d]]).sum(1, dtype=np.int64)
                    ok = (count[a] + count[d] - apart) // 2 >= needed(sizes[a], sizes[d], threshold)
                    if ok.any():
                        hopeful.append((a[ok], d[ok]))
    if not hopeful:
        return
    i, j = (np.concatenate([h[k] for h in hopeful]) for k in range(2))
    order = np.argsort(i, kind="stable")
    i, j = i[order], j[order]
    begins = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
    for s, e in zip(begins, np.r_[begins[1:], len(i)]):
        a, partners = int(i[s]), j[s:e]
        mine = grams[a]
        both, ends = np.concatenate([grams[b] for b in partners.tolist()]), np.cumsum(count[partners])
        hit = mine[np.minimum(np.searchsorted(mine, both), len(mine) - 1)] == both
        common = np.add.reduceat(hit.astype(np.int64), np.r_[0, ends[:-1]])
        index = common / (sizes[a] + sizes[partners] - common)
        found = np.flatnonzero(index >= threshold - 1e-12)
        if len(found):
            yield np.full(len(found), a), partners[found], index[found]


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least index connected with each of n."""
    root = np.arange(n)
    while True:
        was = root.copy()
        np.minimum.at(root, i, root[j])
        np.minimum.at(root, j, root[i])
        root = root[root]
        if (root == was).all():
            return root


def _in_groups(sets: DataFrame, threshold: float) -> DataFrame:
    """(home, part, other_home, other_part, side, set): the cells of each set, that is the pairs of groups over which it met another."""
    spark = sets.sparkSession

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in _cells(batches, _TILE, 4 << 20):
            c["one"] = c["x"] == c["y"]
            least, used = c["set"].copy(), np.zeros(len(c["end"]), bool)
            for a, b in met(c, threshold):
                used[a] = used[b] = True
                np.minimum.at(least, a, c["set"][b])
                np.minimum.at(least, b, c["set"][a])
            at = np.flatnonzero(used)
            if len(at):
                numbers = [pa.array(c[k][at].astype(kind)) for k, kind in _MET]
                yield pa.RecordBatch.from_arrays([*numbers, pa.array([c["firsts"][k] for k in at], pa.binary()), pa.array(least[at])], [*(k for k, _ in _MET), "firsts", "least"])

    ddl = "tile bigint, x int, y int, side int, set bigint, size int, rest int, pos int, firsts binary, least bigint"
    placed = _in_cells(sets).repartition(*_TILE).sortWithinPartitions(*_TILE, "size", "set")
    mates = written(placed.mapInArrow(meet, ddl), "mates")
    del placed
    release(spark)
    homes = mates.groupBy("set").agg(F.min("least").alias("home"))
    parts = homes.groupBy("home").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    homes = homes.join(parts, "home").select("set", "home", F.pmod(F.xxhash64("set"), "parts").cast("int").alias("part"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))  # rows are small beside the work they make, so partitions stay as many
    again = mates.drop("least").join(homes, "set").repartition(n, *_TILE).sortWithinPartitions(*_TILE, "size", "set")

    def meet_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in _cells(batches, _TILE, 4 << 20):
            c["one"] = c["x"] == c["y"]
            groups, of = np.unique(np.stack([c["home"], c["part"]], 1), axis=0, return_inverse=True)  # in order, so numbers compare like groups
            of, n, found = of.reshape(-1), len(c["end"]), []
            for a, b in met(c, threshold):
                turned = of[a] > of[b]
                a, b = np.where(turned, b, a), np.where(turned, a, b)
                cell = of[a] * len(groups) + of[b]
                found += [(cell * n + a) * 2, (cell * n + b) * 2 + (of[a] != of[b])]
                if len(found) > 256:
                    found = [np.unique(np.concatenate(found))]
            if found:
                codes = np.unique(np.concatenate(found))
                side, (cell, at) = codes & 1, np.divmod(codes >> 1, n)
                one, other = groups[cell // len(groups)], groups[cell % len(groups)]
                columns = [one[:, 0], one[:, 1].astype(np.int32), other[:, 0], other[:, 1].astype(np.int32), side.astype(np.int32), c["set"][at]]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], [*_CELL, "side", "set"])

    return again.mapInArrow(meet_groups, "home bigint, part int, other_home bigint, other_part int, side int, set bigint").distinct()


_MET = (("tile", np.int64), ("x", np.int32), ("y", np.int32), ("side", np.int32), ("set", np.int64), ("size", np.int32), ("rest", np.int32), ("pos", np.int32))


def _linked(sets: DataFrame, threshold: float, pairs: bool) -> DataFrame:
    """(set, links, root) of each cell: the documents of other sets that a set links with there, and one of the sets connected with it; or the pairs."""
    full = _in_groups(sets, threshold).join(sets.select("set", "size", "copies", "grams"), "set").repartition(int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")), *_CELL).sortWithinPartitions(*_CELL, "size", "set")

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in _cells(batches, _CELL, 8 << 20):
            c["one"] = (c["home"] == c["other_home"]) & (c["part"] == c["other_part"])
            found = list(settled(c, threshold))
            if not found:
                continue
            i, j, index = (np.concatenate([f[k] for f in found]) for k in range(3))
            set_ = c["set"]
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array(set_[i]), pa.array(set_[j]), pa.array(index)], ["set", "other", "jaccard"])
                continue
            links = np.bincount(i, c["copies"][j], len(set_)) + np.bincount(j, c["copies"][i], len(set_))
            at, root = np.flatnonzero(links), _forest(len(set_), i, j)
            yield pa.RecordBatch.from_arrays([pa.array(set_[at]), pa.array(links[at].astype(np.int64)), pa.array(set_[root[at]])], ["set", "links", "root"])

    return full.mapInArrow(settle, "set bigint, other bigint, jaccard double" if pairs else "set bigint, links bigint, root bigint")


def similar_pairs(docs: DataFrame, n: int = N, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_a, doc_b, jaccard): pairs of classes of equal sets, each named by its least doc_id; the index is rounded to 6 places."""
    texts, sets = shared_grams(docs, n, threshold)
    members = members_of(texts)
    named = sets.select("set", "d1", "d2").join(members, ["d1", "d2"]).groupBy("set").agg(F.min("doc_id").alias("doc"))
    pairs = _linked(sets, threshold, True).join(named.select("set", F.col("doc").alias("a")), "set").join(named.select(F.col("set").alias("other"), F.col("doc").alias("b")), "other")
    return pairs.select(F.least("a", "b").alias("doc_a"), F.greatest("a", "b").alias("doc_b"), F.round("jaccard", 6).alias("jaccard"))


def similar_documents(docs: DataFrame, n: int = N, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id, n_links) of each document that another reaches the threshold with.

    class_id is the least doc_id of the documents that are connected with it by links; n_links is the number of documents
    linked with it directly, those with the same set included.
    """
    return _classes(*shared_grams(docs, n, threshold), threshold).select("doc_id", "class_id", "n_links")


def _classes(texts: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(doc_id, d1, d2, class_id, n_links) of the documents that have links."""
    members = members_of(texts)
    cells = written(_linked(sets, threshold, False), "links")
    links = cells.groupBy("set").agg(F.sum("links").alias("links"))
    roots = components(cells.where("set <> root").select(F.col("set").alias("u"), F.col("root").alias("v")))
    known = sets.select("set", "d1", "d2", "copies").join(links, "set", "left").join(roots.withColumnRenamed("node", "set"), "set", "left")
    known = known.select("d1", "d2", F.coalesce("root", "set").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")).where("n_links > 0")
    # Sets without shared n-grams may have copies: a set counts once for each block that holds it.
    alone = members.join(sets.select("d1", "d2"), ["d1", "d2"], "left_anti").groupBy("d1", "d2").agg(F.count("*").alias("copies"), F.min("doc_id").alias("class_id")).where("copies > 1")
    alone = members.join(alone, ["d1", "d2"]).select("doc_id", "d1", "d2", "class_id", (F.col("copies") - 1).alias("n_links"))
    each = members.join(known, ["d1", "d2"])
    least = each.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    return each.join(least, "root").select("doc_id", "d1", "d2", "class_id", "n_links").unionByName(alone)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of (u, v) edges: root is the least node of its connected component.

    Alternates large-star and small-star steps, each a grouping by one node, until nothing changes; the number of
    rounds is logarithmic in the longest path for all but contrived graphs.
    """
    now = cut(edges.select(F.col("u").cast("bigint").alias("u"), F.col("v").cast("bigint").alias("v")).where("u <> v").distinct())
    state = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        now = cut(small)
        was, state = state, now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if was is not None and tuple(was) == tuple(state):
            break
    found = now.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())


def drop_near_copies(docs: DataFrame, n: int = N, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs less all but the least doc_id of each class of connected documents.

    Rows that repeat a kept doc_id in its class stay as they are, and so do rows with a null doc_id. A doc_id of several texts may lose some of them.
    """
    texts, sets = shared_grams(docs, n, threshold)
    classes = _classes(texts, sets, threshold).where("doc_id <> class_id")
    id_, text = unused(docs.columns, "__gone", "__text")
    gone = texts.distinct().join(classes, ["doc_id", "d1", "d2"]).select(F.col("doc_id").alias(id_), F.col("th").alias(text))
    return docs.join(gone, (docs["doc_id"].cast("bigint") == gone[id_]) & (F.xxhash64(docs["text"].cast("string")) == gone[text]), "left_anti")


#: DuckDB SQL for :func:`similar_documents` of ``documents``.
SQL = """
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: x <> '') AS w FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
g AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END)) AS grams FROM d WHERE len(w) > 0),
m AS (SELECT DISTINCT doc_id, grams FROM g),
s AS (SELECT row_number() OVER (ORDER BY grams) AS s, grams, len(grams) AS size, count(*) AS copies, min(doc_id) AS first FROM m GROUP BY grams),
x AS (SELECT s, unnest(grams) AS gram FROM s),
o AS (SELECT a.s AS a, b.s AS b, count(*) AS n FROM x a JOIN x b ON a.gram = b.gram AND a.s < b.s GROUP BY ALL),
p AS (SELECT a, b FROM o JOIN s sa ON sa.s = a JOIN s sb ON sb.s = b WHERE 2 * n >= sa.size + sb.size - n),
e AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT s AS a, s AS b FROM s UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
c AS (SELECT r.a AS s, min(s.first) AS class_id FROM r JOIN s ON s.s = r.b GROUP BY r.a),
l AS (SELECT e.a AS s, sum(s.copies) AS links FROM e JOIN s ON s.s = e.b GROUP BY e.a),
k AS (SELECT s.grams, c.class_id, CAST(s.copies - 1 + coalesce(l.links, 0) AS BIGINT) AS n_links FROM s JOIN c USING (s) LEFT JOIN l USING (s))
SELECT m.doc_id, k.class_id, k.n_links FROM m JOIN k ON k.grams = m.grams WHERE k.n_links > 0
"""

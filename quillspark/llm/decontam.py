"""Benchmark decontamination by templates.

Words are canonicalised: numbers, names (capitalised words that do not begin a sentence; a run counts as one)
and quantities (a number with a unit word after it, a unit written onto it or a currency sign) become typed placeholders, one each,
other words lose case and surrounding punctuation. A line break may end a sentence or not, so a document is read both ways where that
makes a difference. Every window of ``width`` canonical words of a document is looked up by
hash among the windows of the benchmark items; matches are confirmed on the template's text. Matched windows of a
document and an item that lie on one diagonal are one occurrence; it is joined by those of diagonals up to ``MOST_SHIFTED`` words away that
keep the order of both texts, so words may be added or left out. In an occurrence each of the item's slot values must
stand for one value of its type in the document, and no two for the same one; where that fails on a diagonal it is
no re-parameterised copy and is dropped, and a diagonal that contradicts the others isn't joined. Names at the ends of a diagonal's
matches aren't compared, since a run of names may go on beyond them. A document is contaminated by an item if an occurrence holds at least
``min_coverage`` of the item's windows.

Defined results: null or empty texts, and documents with a null doc_id, match nothing; items with a null id or
fewer words than ``width`` are matched as one window of all their words if they have ``min_words`` words, else never; an item_id with several texts
stands for each of them, and the best covered one counts;
windows with fewer than ``min_literal`` words that are no placeholders are not used; repeated rows count once;
empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.llm.common import Bounded, documents, hash64, map_batches, mix, span_hashes, texts_of, window_hashes

WIDTH = 8
MIN_WORDS = 5
MIN_LITERAL = 4
MIN_COVERAGE = 0.5
#: Canonical words by which an occurrence may drift from its main diagonal.
MOST_SHIFTED = 8
#: Benchmark windows up to this number (8 bytes each) are sent to the executors as a first filter; more are sent as a bitmap of their hashes' leading bits.
MOST_SENT = 4_000_000
#: Bits of that bitmap at most, as a power of two: 128 MB. What it lets through is joined, so its size bears on speed only.
MOST_BITS = 30
#: Characters of documents that are read at once, besides those of the first.
CHARS_AT_ONCE = 2_000_000

UNITS = frozenset(
    "mm cm m km in ft yd mi mg g kg t lb lbs oz ml l cl dl s sec secs min mins h hr hrs ms kb mb gb tb hz khz mhz ghz w kw v a j kj cal kcal pa kpa bar c f k % ° "
    "meter meters metre metres kilometer kilometers kilometre kilometres centimeter centimeters inch inches foot feet yard yards mile miles gram grams kilogram "
    "kilograms ton tons pound pounds ounce ounces liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months "
    "year years dollar dollars euro euros cent cents percent degree degrees watt watts volt volts stunde stunden tag tage woche wochen jahr jahre heure heures jour jours "
    "semaine semaines mois an ans hora horas dia dias semana semanas mes meses año años".split()
)
_NUMBER = re.compile(r"[-+]?[$€£]?(?:\d+(?:[.,:/]\d+)*)([^\W\d_]+|[%°$€£])?")
_CURRENCY = {"$": "dollars", "€": "euros", "£": "pounds"}
_ENDS, _NUM, _UNIT, _NAME, _UNITED = 1, 2, 4, 8, 16
_KINDS = {"<number>": hash64("<number>"), "<name>": hash64("<name>"), "<quantity>": hash64("<quantity>")}
_STRIP = "\"'`“”‘’«».,;:!?()[]{}<>…*_~|"


def core(word: str) -> str:
    """The word without surrounding punctuation."""
    return word.strip(_STRIP)


def _read(raw: bytes) -> tuple[int, bytes]:
    """A word's flags, and the word in lower case without surrounding punctuation."""
    word = raw.decode("utf-8", "surrogatepass")
    inner, flags = core(word), 0
    if word.rstrip("\"'”’»)]*_").endswith((".", "!", "?", "…", ":")):
        flags |= _ENDS
    if not inner:
        return flags, b""  # punctuation alone: no word
    m = _NUMBER.fullmatch(inner)
    if m and (m[1] is None or m[1] in _CURRENCY or m[1].lower() in UNITS):
        flags |= _NUM | (_UNITED if m[1] or any(c in inner for c in _CURRENCY) else 0)
    elif inner.lower() in UNITS:
        flags |= _UNIT
    if inner[0].isupper() and len(inner) > 1 and not inner.isupper():
        flags |= _NAME
    return flags, inner.lower().encode("utf-8", "surrogatepass")


_READ = Bounded(_read)

#: What a byte of a plain word may be; _ODD, and a second byte after 0xC3 (of À to ÿ) by its own table: _read must have the word.
_EDGE, _AFTER, _STOP, _UPPER, _LOWER, _ODD = 1, 2, 4, 8, 16, 32
_BYTES, _SECOND = np.zeros(256, np.uint8), np.full(256, _ODD, np.uint8)
for _chars, _kind in ((_STRIP, _EDGE), ("\"')]*_", _AFTER), (".!?:", _STOP), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", _UPPER), ("abcdefghijklmnopqrstuvwxyz", _LOWER), ("0123456789", _ODD)):
    _BYTES[[ord(c) for c in _chars if c.isascii()]] |= _kind
_BYTES[0x80:] = _ODD
for _char in map(chr, range(0xC0, 0x100)):
    _SECOND[_char.encode()[1]] = _UPPER if _char.isupper() else _LOWER if _char.islower() else _ODD
_SCRAMBLED = mix(np.arange(1, 257, dtype=np.uint64))


def _hashed(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of pieces of bytes, equal wherever the pieces are equal."""
    return span_hashes(_SCRAMBLED[data], begin, end)


_UNIT_HASHES = np.sort([_hashed(np.frombuffer(u, np.uint8), np.array([0]), np.array([len(u)]))[0] for u in (u.encode() for u in UNITS)])


def _packed(words: pa.BinaryArray) -> np.ndarray:
    """For each word a hash of the canonical word in the upper bits, and flags in the lower five, as :func:`_read` has them.

    Words of letters up to ÿ and of ASCII punctuation are read here, all at once: most words of a corpus are rare, and a memo has them seldom.
    """
    at = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2], np.uint8)[at[0] : at[-1]]
    at -= at[0]
    begin, end = at[:-1], at[1:]
    kinds = _BYTES[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    kinds[lead + 1] = _SECOND[data[lead + 1]]
    kinds[lead] = kinds[lead + 1] & _UPPER
    place = np.arange(len(data))

    def last(kind: int) -> np.ndarray:
        """The last byte of each word that isn't of the kind, or one before the word."""
        return np.maximum.accumulate(np.where(kinds & kind, -1, place))[end - 1]

    def count(kind: int, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        n = np.concatenate([[0], np.cumsum((kinds & kind) > 0)])
        return n[end] - n[begin]

    stop = np.maximum(last(_EDGE) + 1, begin)
    start = np.minimum(np.minimum.accumulate(np.where(kinds & _EDGE, len(data), place)[::-1])[::-1][begin], stop)
    tail = last(_AFTER)
    flags = np.where((tail >= begin) & ((kinds[tail] & _STOP) > 0), _ENDS, 0).astype(np.uint64)
    lower = np.where((kinds & _UPPER) > 0, data + np.uint8(32), data)
    lower[lead] = 0xC3
    found = _hashed(lower, start, stop)
    some = start < stop
    flags[some & ((kinds[np.minimum(start, len(data) - 1)] & _UPPER) > 0) & (count(_LOWER, start, stop) > 0)] |= np.uint64(_NAME)
    flags[_UNIT_HASHES[np.minimum(np.searchsorted(_UNIT_HASHES, found), len(_UNIT_HASHES) - 1)] == found] |= np.uint64(_UNIT)
    odd = np.flatnonzero(count(_ODD, begin, end))
    if len(odd):
        read = [_READ[w] for w in words.take(pa.array(odd)).to_numpy(zero_copy_only=False)]
        ends = np.cumsum([0] + [len(w) for _, w in read])
        flags[odd] = [f for f, _ in read]
        found[odd] = _hashed(np.frombuffer(b"".join(w for _, w in read), np.uint8), ends[:-1], ends[1:])
        some[odd] = ends[:-1] < ends[1:]
    found &= ~np.uint64(31)
    found[found == 0] = 32
    return np.where(some, found, np.uint64(0)) | flags


#: 1 for bytes that are white space to str.split, 2 for those that may begin white space of several bytes.
_SPACES = np.zeros(256, np.uint8)
_SPACES[list(b"\t\n\v\f\r\x1c\x1d\x1e\x1f ")] = 1
_SPACES[[0xC2, 0xE1, 0xE2, 0xE3]] = 2
_WIDE_SPACES = np.array([int.from_bytes(c.encode(), "big") for c in "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"], np.uint32)


def _split(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All the texts' words as :func:`_packed` has them, for each text the index of its first word, and which words a line break parts from the word before.

    Words are those of str.split, line breaks those of str.splitlines; a word is read once, however often it occurs.
    """
    encoded = [text.encode("utf-8", "surrogatepass") for text in texts]
    data = np.frombuffer(b" " + b" ".join(encoded) + b"   ", np.uint8)
    kinds = _SPACES[data]
    space = kinds == 1
    lead = np.flatnonzero(kinds == 2)
    if len(lead):
        one, two, three = (data[lead + k].astype(np.uint32) for k in range(3))
        narrow = lead[(one == 0xC2) & ((two == 0x85) | (two == 0xA0))]
        wide = lead[np.isin(one << 16 | two << 8 | three, _WIDE_SPACES)]
        for at in (narrow, narrow + 1, wide, wide + 1, wide + 2):
            space[at] = True
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1  # beginnings and ends of words by turns
    if not len(edges):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64), np.zeros(0, bool)
    begin = np.cumsum([1] + [len(e) + 1 for e in encoded])[:-1]
    parts = pa.BinaryArray.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(data)]).dictionary_encode()
    codes, values = parts.indices.to_numpy(), parts.dictionary
    gap = np.zeros(len(values), bool)
    gap[codes[1::2]] = True
    packed, breaks = np.zeros(len(values), np.uint64), np.zeros(len(values), bool)
    packed[~gap] = _packed(values.filter(pa.array(~gap)))
    breaks[gap] = [len(f"a{g.decode()}a".splitlines()) > 1 for g in values.filter(pa.array(gap)).to_pylist()]
    return packed[codes[::2]], np.searchsorted(edges[::2], begin), np.concatenate([[False], breaks[codes[1::2]]])


def canonical(text: str) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Hashes of the canonical words of a text, for each the index of its first raw word, and the raw words."""
    return *_canonical(_split([text])[0]), text.split()


#: Stands before each text where several are read as one: it ends a sentence and is no word of any text.
_BOUND = np.uint64(hash64("\n") & ~31 | _ENDS)


class Reading:
    """Canonical words of several texts, one after the other, each text with ``_BOUND`` before it."""

    def __init__(self, x: np.ndarray, bound: np.ndarray, texts: np.ndarray):
        #: Which texts they are, and where each begins among raw and canonical words.
        self.texts, self.raw = texts, np.flatnonzero(bound)
        self.hashes, self.first = _canonical(x)
        self.at = np.searchsorted(self.first, self.raw)

    def of(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """What :func:`canonical` has for the k-th text, but for the raw words."""
        own = slice(self.at[k] + 1, self.at[k + 1] if k + 1 < len(self.at) else None)
        return self.hashes[own], self.first[own] - self.raw[k] - 1

    def inside(self, found: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Of windows at these places those within one text, and that text's place in ``texts``."""
        k = np.searchsorted(self.at, found, "right") - 1
        within = (found > self.at[k]) & (found + width <= np.append(self.at[1:], len(self.hashes))[k])
        return found[within], k[within]


def readings(texts: list[str]) -> list[Reading]:
    """The texts' canonical words, and a second time with line breaks as ends of sentences for the texts where that makes a difference."""
    words, begin, broken = _split(texts)
    every = np.arange(len(texts))
    x, broken, bound = np.insert(words, begin, _BOUND), np.insert(broken, begin, False), np.zeros(len(words) + len(texts), bool)
    bound[begin + every] = True
    broken[1:] &= ~bound[:-1]  # a text's first word
    open_ends = np.flatnonzero(broken & ((x & np.uint64(_NAME | _UNIT)) > 0))
    open_ends = open_ends[(x[open_ends - 1] & np.uint64(_ENDS)) == 0]
    found = [Reading(x, bound, every)]
    if len(open_ends):
        text = np.cumsum(bound) - 1
        twice = np.zeros(len(texts), bool)
        twice[text[open_ends]] = True
        ended = x.copy()
        ended[open_ends - 1] |= np.uint64(_ENDS)
        own = twice[text]
        found.append(Reading(ended[own], bound[own], every[twice]))
    return found


def _canonical(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(x):
        return x, np.zeros(0, np.int64)
    flags = (x & np.uint64(31)).astype(np.uint8)
    ends = (flags & _ENDS) > 0
    starts = np.empty(len(x), bool)
    starts[0], starts[1:] = True, ends[:-1]
    real = (x >> np.uint64(5)) > 0
    kept = np.flatnonzero(real)
    if len(kept) < len(x):  # a sentence's end may stand apart from its last word
        gap = np.cumsum(starts)
        before = np.concatenate([[0], gap[kept[:-1]]]) if len(kept) else gap[:0]
        starts = (gap[kept] > before) if len(kept) else starts[:0]
        flags, x = flags[kept], x[kept]
    numbers = (flags & _NUM) > 0
    units = np.zeros(len(x), bool)
    if len(x):
        units[1:] = ((flags[1:] & _UNIT) > 0) & numbers[:-1] & ((flags[:-1] & _UNITED) == 0) & ~starts[1:]
    names = ((flags & _NAME) > 0) & ~starts & ~numbers & ~units
    out = x & ~np.uint64(31)
    out[numbers] = _KINDS["<number>"]
    out[numbers & ((flags & _UNITED) > 0)] = _KINDS["<quantity>"]
    out[np.flatnonzero(units) - 1] = _KINDS["<quantity>"]
    out[names] = _KINDS["<name>"]
    run = np.zeros(len(x), bool)
    run[1:] = names[1:] & names[:-1]
    whole = ~(run | units)
    return out[whole], kept[whole]


_PLACEHOLDERS = np.array(sorted(_KINDS.values()), np.uint64)
_KIND_OF = {v: k for k, v in _KINDS.items()}


def _windows(hashes: np.ndarray, width: int, min_literal: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows, and which of them hold enough literal words."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    literal = np.concatenate([[0], np.cumsum(~np.isin(hashes, _PLACEHOLDERS))])
    return window_hashes(hashes, width), literal[width:] - literal[:-width] >= min_literal


def _describe(hashes: np.ndarray, first: np.ndarray, words: list[str], at: int, width: int) -> tuple[str, list[str]]:
    """The template of a window as text, and its slots as "kind offset value"."""
    template, slots = [], []
    for k in range(at, at + width):
        kind = _KIND_OF.get(int(hashes[k]))
        stop = first[k + 1] if k + 1 < len(first) else len(words)
        raw = [c for c in map(core, words[first[k] : stop]) if c]
        if kind == "<name>":
            raw = [c for c in raw if c[0].isupper()]
        template.append(kind or raw[0].lower())
        if kind:
            value = " ".join(raw).lower()
            if kind == "<quantity>":
                value = value.replace(" ", "")
                for sign, name in _CURRENCY.items():
                    if sign in value:
                        value = value.replace(sign, "") + name
            slots.append(f"{kind}\x1f{value}")
    return " ".join(template), slots


_FOUND = pa.schema([("id", pa.int64()), ("reading", pa.int32()), ("size", pa.int32()), ("at", pa.int32()), ("window", pa.int64()), ("template", pa.string()), ("slots", pa.list_(pa.string())), ("n_windows", pa.int32())])
_DDL = "id bigint, reading int, size int, at int, window bigint, template string, slots array<string>, n_windows int"


class Wanted:
    """Which hashes the benchmark's windows may have: sorted ones, or a bitmap of leading bits."""

    def __init__(self, hashes: np.ndarray | None, bitmap: np.ndarray | None = None):
        self.hashes, self.bitmap = hashes, bitmap
        self.shift = None if bitmap is None else np.uint64(64 - (len(bitmap) * 8).bit_length() + 1)

    def has(self, found: np.ndarray) -> np.ndarray:
        if self.bitmap is not None:
            at = found >> self.shift
            return (self.bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
        if not len(self.hashes):
            return np.zeros(len(found), bool)
        return self.hashes[np.minimum(np.searchsorted(self.hashes, found), len(self.hashes) - 1)] == found


def wanted_windows(windows: DataFrame, n: int, most_sent: int = MOST_SENT) -> Wanted:
    """The filter for n distinct windows. Tasks make the bitmap in pieces, so the driver holds its bits and no hashes."""
    if n <= most_sent:
        return Wanted(np.sort(windows.select("window").distinct().toArrow()["window"].to_numpy().view(np.uint64)))
    bits = min(MOST_BITS, max(16, (16 * n - 1).bit_length()))
    piece = bits - 10

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks: dict[int, np.ndarray] = {}
        for batch in batches:
            at = batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - bits)
            for k in np.unique(at >> np.uint64(piece)).tolist():
                own = (at[at >> np.uint64(piece) == k] & np.uint64((1 << piece) - 1)).astype(np.int64)
                np.bitwise_or.at(marks.setdefault(k, np.zeros(1 << piece - 3, np.uint8)), own >> 3, np.left_shift(1, own & 7).astype(np.uint8))
        if marks:
            yield pa.RecordBatch.from_arrays([pa.array(marks.keys(), pa.int32()), pa.array([m.tobytes() for m in marks.values()], pa.binary())], ["piece", "bits"])

    pieces = windows.select("window").repartition(F.shiftrightunsigned("window", 54)).mapInArrow(mark, "piece int, bits binary").toArrow()
    bitmap = np.zeros(1 << bits - 3, np.uint8)
    for k, own in zip(pieces["piece"].to_pylist(), pieces["bits"].to_pylist()):
        bitmap[k << piece - 3 : (k + 1) << piece - 3] |= np.frombuffer(own, np.uint8)
    return Wanted(None, bitmap)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in _FOUND]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FOUND)], schema=_FOUND)


def _of_items(batch: pa.RecordBatch, width: int, least: int, min_literal: int) -> pa.RecordBatch:
    """Windows of a batch's items of the main width, or one of all words of a short item; their reading is the variant."""
    rows = []
    for item_id, text, variant in zip(batch.column(0).to_pylist(), texts_of(batch), batch.column(2).to_pylist()):
        if item_id is None or not text:
            continue
        hashes, first, words = canonical(text)
        size = min(width, len(hashes))
        if size < min(least, width):
            continue
        found, usable = _windows(hashes, size, min(min_literal, size))
        n = int(usable.sum())
        for k in np.flatnonzero(usable).tolist():
            rows.append((item_id, variant, size, k, int(found[k : k + 1].view(np.int64)[0]), *_describe(hashes, first, words, k, size), n))
    return _batch(rows)


def _of_documents(batch: pa.RecordBatch, sizes: list[int], min_literal: int, wanted: Wanted) -> pa.RecordBatch:
    """Windows of a batch's documents that may be wanted. Only documents that have such are split in Python."""
    every = [(i, t) for i, t in zip(batch.column(0).to_pylist(), texts_of(batch)) if i is not None and t]
    ends = np.cumsum([len(t) for _, t in every])
    rows = []
    for part in np.split(np.arange(len(every)), np.flatnonzero(np.diff(ends // CHARS_AT_ONCE)) + 1):
        if not len(part):
            continue
        own = every[part[0] : part[-1] + 1]
        for number, reading in enumerate(readings([t for _, t in own])):
            last, hashes, first, words = -1, None, None, []
            for width in sizes:
                found, usable = _windows(reading.hashes, width, min(min_literal, width))
                at = np.flatnonzero(usable)
                at = at[wanted.has(found[at])]
                for k, text in zip(*(x.tolist() for x in reading.inside(at, width))):
                    if text != last:
                        doc_id, raw = own[reading.texts[text]]
                        last, words, (hashes, first) = text, raw.split(), reading.of(text)
                    local = k - int(reading.at[text]) - 1
                    rows.append((doc_id, number, width, local, int(found[k : k + 1].view(np.int64)[0]), *_describe(hashes, first, words, local, width), None))
    return _batch(rows)


def _joined(forth: dict[str, str], back: dict[str, str], pairs: list[tuple[str, str]]) -> tuple[dict[str, str], dict[str, str]] | None:
    """Both maps with the pairs added, or None if they contradict."""
    forth, back = dict(forth), dict(back)
    for a, b in pairs:
        if forth.setdefault(a, b) != b or back.setdefault(b, a) != a:
            return None
    return forth, back


def _pairs(hits: list[dict]) -> list[tuple[str, str]]:
    """Slot values of an item and a document on one diagonal, without names at its ends; hits are in order."""
    found = []
    for k, h in enumerate(hits):
        own = list(zip(h["item_slots"], h["slots"]))
        if k == len(hits) - 1 and h["template"].endswith("<name>"):
            own = own[:-1]
        if k == 0 and h["template"].startswith("<name>"):
            own = own[1:]
        found += own
    return list(dict.fromkeys(found))


def best_chain(hits: list[dict], most: int, least: float = 0.0) -> int:
    """The most item windows in one occurrence, of at most ``most``; an occurrence below ``least`` needn't be found."""
    by: dict[int, list[dict]] = {}
    for h in sorted(hits, key=lambda h: h["item_at"]):
        by.setdefault(h["at"] - h["item_at"], []).append(h)
    best, pairs = 0, {}
    for d in sorted(by, key=lambda d: (-len(by[d]), d)):
        near = [d] + [d + sign * k for k in range(1, MOST_SHIFTED + 1) for sign in (1, -1) if d + sign * k in by]
        possible = len({h["item_at"] for x in near for h in by[x]})
        if possible <= best or possible < least:
            continue
        if d not in pairs:
            pairs[d] = _pairs(by[d])
        maps = _joined({}, {}, pairs[d])
        if maps is None:
            continue
        chain = [(h["item_at"], h["at"]) for h in by[d]]
        for x in near[1:]:
            fits = []
            for h in by[x]:
                k = bisect_left(chain, (h["item_at"],))
                if (k == 0 or chain[k - 1][1] < h["at"]) and (k == len(chain) or chain[k][0] > h["item_at"] and chain[k][1] > h["at"]):
                    fits.append(h)
            grown = fits and _joined(*maps, _pairs(fits))
            if grown:
                maps, chain = grown, sorted(chain + [(h["item_at"], h["at"]) for h in fits])
        best = max(best, len(chain))
        if best >= most:
            break
    return best


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, min_words: int = MIN_WORDS, min_literal: int = MIN_LITERAL, min_coverage: float = MIN_COVERAGE, most_sent: int = MOST_SENT) -> DataFrame:
    """(doc_id, item_id, coverage): the items that contaminate each document, with the covered share of the item's windows."""
    items = documents(benchmark, "item_id", "text").dropDuplicates().withColumn("variant", F.row_number().over(W.partitionBy("doc_id").orderBy("text")))
    windows = map_batches(items, lambda b: _of_items(b, width, min_words, min_literal), _DDL)
    windows = windows.select(F.col("id").alias("item_id"), F.col("reading").alias("variant"), "size", F.col("at").alias("item_at"), "window", F.col("template").alias("item_template"), F.col("slots").alias("item_slots"), "n_windows")
    spark = docs.sparkSession
    hashes = windows.select("size", "window").distinct()
    counts = {r["size"]: r["n"] for r in hashes.groupBy("size").agg(F.count("*").alias("n")).collect()}  # a row for each width up to the main one
    sizes = sorted(counts)
    wanted = spark.sparkContext.broadcast(wanted_windows(hashes, sum(counts.values()), most_sent))
    texts = documents(docs).where("doc_id is not null and text <> ''")
    found = map_batches(texts, lambda b: _of_documents(b, sizes, min_literal, wanted.value), _DDL)
    found = found.select(F.col("id").alias("doc_id"), "reading", "size", "at", "window", "template", "slots")
    hits = found.join(windows, ["size", "window"]).where("template = item_template")
    hits = hits.groupBy("doc_id", "item_id", "variant", "reading").agg(F.max("n_windows").alias("n_windows"), F.collect_set(F.struct("at", "item_at", "template", "item_slots", "slots")).alias("hits"))
    # Fewer matches than that are no occurrence, however they lie.
    hits = hits.where(F.size("hits") >= F.col("n_windows") * min_coverage - 1)

    def chained(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = batch.to_pylist()
        shares = [best_chain(r["hits"], r["n_windows"], r["n_windows"] * min_coverage - 1) / r["n_windows"] for r in rows]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(shares, pa.float64())], ["doc_id", "item_id", "coverage"])

    return (
        map_batches(hits, chained, "doc_id bigint, item_id bigint, coverage double")
        .groupBy("doc_id", "item_id")
        .agg(F.round(F.max("coverage"), 6).alias("coverage"))
        .where((F.col("coverage") >= min_coverage) & (F.col("coverage") > 0))
    )

"""Byte-level BPE: encoding by a lazily determinised transducer, streaming decoding, and token counts.

Encoding. A sequence of vocabulary tokens is the BPE encoding of its bytes exactly when every
neighbouring pair is the BPE encoding of its own bytes. That makes BPE a regular relation: the
non-deterministic transducer's states are (last token, trie node of the token being read), it may end a token
where the trie node holds one that is compatible with the last token, and for any input one path alone
accepts. :class:`Transducer` determinises it by subset construction with delayed output: a state is a set of
live paths with the tokens each still owes, what all of them owe in common is emitted, and
transitions are built when first taken. Paths that lead nowhere die within the length of a few tokens, so
output follows input after a bounded lookahead.

Decoding. :class:`StreamingDecoder` keeps the state of a UTF-8 automaton between tokens.

Counting. :func:`merge_count` repeatedly pops the lowest-rank adjacent pair from a heap over a linked list:
the number of tokens is the number of bytes less the merges made. No identifiers are produced.

Defined results: a null text has null tokens, count and round trip; an empty text has no tokens and counts 0; rows
with a null or repeated doc_id stay as they are; columns other than id and text are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from array import array
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quillspark.llm.common import Bounded, documents, lists, map_batches, texts_of

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How text is cut before merging: contractions, letters, digits, other signs, white space.
PRETOKEN = r"'(?:[stmd]|re|ve|ll)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_NONE = 1 << 60


def read_ranks(data: bytes) -> dict[bytes, int]:
    """The ranks of a file with a base64 token and its rank on each line."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


def merge_count(ranks: dict[bytes, int], piece: bytes) -> int:
    """Tokens of a piece: its bytes less the merges of a heap over a linked list of symbols."""
    n = len(piece)
    if n < 2 or piece in ranks:
        return min(n, 1)
    end, nxt, prev = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = nxt[i] if end[i] else n
        if j >= n or not end[j] or end[j] != stop:  # one of the two has been merged since
            continue
        merges += 1
        end[i], nxt[i] = stop, nxt[j]
        end[j] = 0
        if nxt[i] < n:
            prev[nxt[i]] = i
            k = end[nxt[i]]
            if (r := ranks.get(piece[i:k])) is not None:
                heapq.heappush(heap, (r, i, k))
        if (p := prev[i]) >= 0 and (r := ranks.get(piece[p:stop])) is not None:
            heapq.heappush(heap, (r, p, stop))
    return n - merges


def merge_tokens(ranks: dict[bytes, int], piece: bytes) -> tuple[int, ...]:
    """Plain BPE: the leftmost pair of lowest rank is merged until none is left."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best, at = _NONE, -1
        for i in range(len(parts) - 1):
            r = ranks.get(parts[i] + parts[i + 1], _NONE)
            if r < best:
                best, at = r, i
        if at < 0:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return tuple(ranks[p] for p in parts)


class Transducer:
    """The determinised transducer of a vocabulary, grown as input needs it.

    Once it has ``most_states`` states, transitions that it lacks are determinised for the moment and not kept; if those
    come to outnumber the states by far, the input has changed and the transducer starts afresh.
    """

    def __init__(self, ranks: dict[bytes, int], most_states: int = 100_000):
        self.ranks, self.most_states = ranks, most_states
        self.bytes_of = {r: t for t, r in ranks.items()}
        self.children: list[dict[int, int]] = [{}]
        self.token: list[int] = [-1]
        for text, rank in ranks.items():
            node = 0
            for b in text:
                child = self.children[node].get(b)
                if child is None:
                    child = self.children[node][b] = len(self.children)
                    self.children.append({})
                    self.token.append(-1)
                node = child
            self.token[node] = rank
        self.reachable = Bounded(lambda t: merge_tokens(ranks, self.bytes_of[t]) == (t,))
        self.compatible = Bounded(lambda p: merge_tokens(ranks, self.bytes_of[p[0]] + self.bytes_of[p[1]]) == p)
        self.longest_delay = 0
        self._reset()

    def _reset(self) -> None:
        self.numbers: dict[tuple, int] = {}
        self.paths: list[tuple] = []
        self.moves: dict[int, tuple[int, tuple[int, ...]]] = {}  # by state << 8 | byte: the next state << 8, and what is emitted
        self.finals: list[tuple[int, ...] | None] = []
        self.unkept = 0
        self._number((((-1, 0), ()),))

    def _number(self, paths: tuple) -> int:
        number = self.numbers.get(paths)
        if number is None:
            number = self.numbers[paths] = len(self.paths)
            self.paths.append(paths)
            self.finals.append(next((owed for (_, node), owed in paths if node == 0), None))
        return number

    def _advance(self, paths: tuple, byte: int) -> tuple[tuple, tuple[int, ...]]:
        """The live paths after a byte, and the tokens that all of them owe in common."""
        found = []
        for (last, node), owed in paths:
            child = self.children[node].get(byte)
            if child is None:
                continue
            if self.children[child]:
                found.append(((last, child), owed))
            token = self.token[child]
            if token >= 0 and self.reachable[token] and (last < 0 or self.compatible[last, token]):
                found.append(((token, 0), (*owed, token)))
        if not found:
            raise ValueError(f"byte {byte} has no token in this vocabulary")
        common = found[0][1]
        for _, owed in found[1:]:
            n = 0
            while n < len(common) and n < len(owed) and common[n] == owed[n]:
                n += 1
            common = common[:n]
        n = len(common)
        self.longest_delay = max(self.longest_delay, *(len(owed) - n for _, owed in found))
        return tuple((where, owed[n:]) for where, owed in found) if n else tuple(found), common

    def _step(self, at: int) -> tuple[int, tuple[int, ...]]:
        paths, common = self._advance(self.paths[at >> 8], at & 255)
        result = self.moves[at] = (self._number(paths) << 8, common)
        return result

    def encode(self, piece: bytes) -> list[int]:
        full = len(self.paths) >= self.most_states
        if full and self.unkept > 32 * self.most_states:
            self._reset()
            full = False
        out: list[int] = []
        state, known = 0, self.moves.get
        passing: tuple | None = None  # the paths, while they belong to no state
        for byte in piece:
            if passing is None:
                move = known(state | byte)
                if move is None and not full:
                    move = self._step(state | byte)
                if move is not None:
                    state, emitted = move
                    if emitted:
                        out += emitted
                    continue
                passing = self.paths[state >> 8]
            passing, emitted = self._advance(passing, byte)
            self.unkept += 1
            if emitted:
                out += emitted
            number = self.numbers.get(passing)
            if number is not None:
                state, passing = number << 8, None
        if passing is None:
            out += self.finals[state >> 8]
        else:
            out += next(owed for (_, node), owed in passing if node == 0)
        return out


#: UTF-8 as an automaton: state 0 stands between characters, others await continuation bytes in a range.
_AWAIT = {1: (0x80, 0xBF, 0), 2: (0x80, 0xBF, 1), 3: (0x80, 0xBF, 2), 4: (0xA0, 0xBF, 1), 5: (0x80, 0x9F, 1), 6: (0x90, 0xBF, 2), 7: (0x80, 0x8F, 2)}


def utf8_step(state: int, byte: int) -> int:
    """The automaton's next state; -1 if the byte can't stand here."""
    if state:
        low, high, then = _AWAIT[state]
        return then if low <= byte <= high else -1
    if byte < 0x80:
        return 0
    if 0xC2 <= byte <= 0xDF:
        return 1
    if 0xE0 <= byte <= 0xEF:
        return {0xE0: 4, 0xED: 5}.get(byte, 2)
    return {0xF0: 6, 0xF4: 7}.get(byte, 3) if 0xF0 <= byte <= 0xF4 else -1


class StreamingDecoder:
    """Text of tokens as they come. Bytes that can't be UTF-8 become U+FFFD, one for each broken sequence."""

    def __init__(self, bytes_of: dict[int, bytes]):
        self.bytes_of = bytes_of
        self.moves = Bounded(lambda key: self._move(*key))
        self.pending = b""
        self.whole: list[str | None] = [None] * (max(bytes_of, default=-1) + 1)
        for token in bytes_of:
            text, rest = self._move(b"", token)
            self.whole[token] = None if rest or "\ufffd" in text else text

    def _move(self, pending: bytes, token: int) -> tuple[str, bytes]:
        """What a token adds after pending bytes of an unfinished character, and the bytes then pending."""
        state, held, out = 0, bytearray(), []
        for byte in pending + self.bytes_of[token]:
            then = utf8_step(state, byte)
            if then < 0:
                if held:
                    out.append("�")
                    held.clear()
                    then = utf8_step(0, byte)
                if then < 0:
                    out.append("�")
                    state = 0
                    continue
            held.append(byte)
            state = then
            if state == 0:
                out.append(held.decode())
                held.clear()
        return "".join(out), bytes(held)

    def feed(self, tokens) -> str:
        moves, pending, out = self.moves, self.pending, []
        for token in tokens:
            text, pending = moves[pending, token]
            out.append(text)
        self.pending = pending
        return "".join(out)

    def finish(self) -> str:
        rest, self.pending = self.pending, b""
        return "�" if rest else ""

    def decode(self, tokens: list[int]) -> str:
        """The text of a whole list. Where every token ends between characters the state stays 0 and its moves are read off a table."""
        try:
            return "".join(map(self.whole.__getitem__, tokens))
        except (TypeError, IndexError):
            return self.feed(tokens) + self.finish()


_LETTER, _DIGIT, _SPACE = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾", r"\t-\r \x85\xa0"
#: The same cuts for text of code points under 256, where a plain character class says what a property does.
_LATIN = re.compile(rf" ?[{_LETTER}]+|'(?:[stmd]|re|ve|ll)| ?[{_DIGIT}]+| ?[^{_SPACE}{_LETTER}{_DIGIT}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")


def is_latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Codec:
    def __init__(self, data: bytes):
        import regex

        self.ranks = read_ranks(data)
        self.any = regex.compile(PRETOKEN).findall
        self.transducer = Transducer(self.ranks)
        self.decoder = StreamingDecoder(self.transducer.bytes_of)
        self.encoded = Bounded(lambda piece: array("i", self.transducer.encode(piece.encode("utf-8", "replace"))).tobytes(), 400_000)
        self.counted = Bounded(lambda piece: merge_count(self.ranks, piece.encode("utf-8", "replace")), 500_000)

    def cut(self, text: str) -> list[str]:
        return (self.any if not is_latin(text) else _LATIN.findall)(text)

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.encoded.__getitem__, self.cut(text))), np.int32) if text else np.zeros(0, np.int32)

    def count(self, text: str) -> int:
        return sum(map(self.counted.__getitem__, self.cut(text))) if text else 0


_DATA: dict[str, bytes] = {}


@lru_cache(maxsize=2)
def _codec(digest: str) -> Codec:
    return Codec(_DATA[digest])


def _shared(df: DataFrame, vocabulary: str):
    """The vocabulary file as a broadcast: executors need no copy of the path."""
    data = Path(vocabulary).read_bytes()
    return df.sparkSession.sparkContext.broadcast(data), hashlib.sha1(data).hexdigest()


def _open(shared, digest: str) -> Codec:
    if digest not in _DATA:
        _DATA[digest] = shared.value
    return _codec(digest)


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens, tokens, round_trip): whole texts encoded, and whether streaming decoding gives the text back."""
    shared, digest = _shared(docs, vocabulary)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec, flat, counts, trips = _open(shared, digest), [], [], []
        for text in texts_of(batch):
            tokens = codec.encode(text)
            trips.append(None if text is None else codec.decoder.decode(tokens.tolist()) == text)
            counts.append(None if text is None else len(tokens))
            flat.append(tokens)
        valid = np.array([c is not None for c in counts], bool)
        tokens = lists(np.concatenate(flat), [len(x) for x in flat], pa.int32(), valid)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int32()), tokens, pa.array(trips, pa.bool_())], ["doc_id", "n_tokens", "tokens", "round_trip"])

    return map_batches(documents(docs, id_col, text_col), work, "doc_id bigint, n_tokens int, tokens array<int>, round_trip boolean")


def decode_tokens(encoded: DataFrame, id_col: str = "doc_id", tokens_col: str = "tokens", vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, text) of token lists. A null list has a null text; a token outside the vocabulary fails the job."""
    shared, digest = _shared(encoded, vocabulary)
    from pyspark.sql import functions as F

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec = _open(shared, digest)
        texts = [None if t is None else codec.decoder.decode(t) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return map_batches(encoded.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(tokens_col).cast("array<int>").alias("tokens")), work, "doc_id bigint, text string")


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens bigint, n_bytes bigint): tokens of each whole text, by merges alone."""
    shared, digest = _shared(docs, vocabulary)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec, texts = _open(shared, digest), texts_of(batch)
        counts = [None if t is None else codec.count(t) for t in texts]
        sizes = [None if t is None else len(t.encode("utf-8", "replace")) for t in texts]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())], ["doc_id", "n_tokens", "n_bytes"])

    return map_batches(documents(docs, id_col, text_col), work, "doc_id bigint, n_tokens bigint, n_bytes bigint")

"""Toxicity: Levenshtein automata intersected with a lexicon trie, and scores of the context around each hit.

The lexicon is a trie of whole terms and of stems (entries that any ending may follow, and within which edits are allowed too). :class:`Matcher` reads a word letter by letter
through the product of the trie and a Levenshtein automaton: a state is a set of (trie node, edits so far),
determinised lazily, so a word costs one table look-up per letter and most words leave the trie within a few.
Longer terms and stems allow more edits (``EDITS``), as far as the words so reached keep out of clean labelled documents.

Some stems stand in clean texts now and then, but not in company: such a paired stem is a hit only within ``NEAR`` words of another word that is a hit or
begins with a paired stem.

A hit weighs less the more edits it needed. Its window of ``WINDOW`` words either side tells quotation from abuse: a hit between
quotation marks, or beside words of reporting or of talk about words, counts for less; one beside a word of address counts
for more. Hits combine as independent evidence: score = 1 - product of (1 - weight).

The lexicon is mined from at most ``max_rows`` labelled documents and ``max_chars`` characters of them, in order of the hash of doc_id (the one bounded sample; both
are parameters): words and stems of at least ``MIN_FAMILIES`` toxic document families with a share of toxic
families of at least ``PRECISION``; paired stems by the same measure of two occurrences within ``NEAR`` words. A family is counted by the least word hash of a document, so that copies count once. Seed terms can be added.

Defined results: null texts score null and are not toxic, empty ones score 0; null doc_ids and repeated rows are scored like
others; labels that are null or contradict each other are left out; without labels the seed terms alone are the lexicon;
other columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import Bounded, documents, hash64, map_batches, ship, sliced, texts_of

#: Least length of a term for one and for two edits.
EDITS = (5, 9)
WINDOW = 6
NEAR = 64
MAX_ROWS = 16_000
#: Characters of labelled texts that are mined at most; a text that would go beyond is left out whole.
MAX_CHARS = 48_000_000
MIN_FAMILIES = 8
PRECISION = 0.95
STEM_LENGTHS = range(4, 9)
MIN_ENDINGS = 4
THRESHOLD = 0.5
SEED = ("idiot", "moron", "stupid", "scum", "worthless", "pathetic", "disgusting")
_BY_EDITS = (0.8, 0.55, 0.4)
#: Share of clean document families that words some edits away from a term may occur in, for those edits to be allowed.
NOISE = 0.0005
_STRIP = "\"'`“”‘’«».,;:!?()[]{}<>…*_~|-"
_QUOTES = re.compile("[\"“”„«»‹›]|(?<!\\w)['‘`]|['’](?!\\w)")
_REPORT = frozenset(
    "said says say saying called calls calling wrote writes quoted quotes quote quoting word words term terms phrase label labelled labeled insult insults slur definition means "
    "sagte sagt nannte genannt wort wörter begriff beleidigung zitat dijo dice llamó llamado palabra palabras término insulto cita dit disait appelé mot mots terme insulte citation".split()
)
_ADDRESS = frozenset("you your you're youre u ur yourself du dich dir dein deine ihr euch tú tu tus te usted ustedes toi ton ta vous votre".split())


class Matcher:
    """The product of a trie and a Levenshtein automaton, determinised as words need it."""

    def __init__(self, terms: dict[str, int], stems: dict[str, int], most_states: int = 100_000):
        self.most_states = most_states
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[tuple[str, int] | None] = [None]  # term and edits allowed
        self.stem: list[tuple[str, int] | None] = [None]
        self.room = [0]  # the most edits that a term below a node allows
        for entry, allowed, is_stem in [*((t, e, False) for t, e in sorted(terms.items())), *((s, e, True) for s, e in sorted(stems.items()))]:
            node, path = 0, [0]
            for c in entry:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append(None)
                    self.stem.append(None)
                    self.room.append(0)
                node = self.children[node][c]
                path.append(node)
            for p in path:
                self.room[p] = max(self.room[p], allowed)
            if is_stem:
                self.stem[node] = (entry, allowed)
            else:
                self.ends[node] = (entry, allowed)
        self._reset()

    def _reset(self) -> None:
        self.numbers: dict[frozenset, int] = {}
        self.sets: list[dict] = []
        self.moves: list[dict[str, int]] = []
        self.accepts: list[tuple[str, int] | None] = []
        self._number({})
        self._number(self._closed({0: 0}))

    def _closed(self, state: dict) -> dict:
        """With the trie letters that a word may lack."""
        todo = list(state.items())
        while todo:
            node, edits = todo.pop()
            for child in self.children[node].values() if isinstance(node, int) else ():
                if edits + 1 <= self.room[child] and edits + 1 < state.get(child, 99):
                    state[child] = edits + 1
                    todo.append((child, edits + 1))
        return state

    def _number(self, state: dict) -> int:
        key = frozenset(state.items())
        if key not in self.numbers:
            self.numbers[key] = len(self.sets)
            self.sets.append(state)
            self.moves.append({})
            best = None
            for node, edits in state.items():
                if isinstance(node, str):
                    tries = [(node, edits)]
                else:
                    tries = [(entry[0], edits) for entry in (self.ends[node], self.stem[node]) if entry and edits <= entry[1]]
                for found in tries:
                    best = found if best is None else min(best, found, key=lambda f: (f[1], -len(f[0]), f[0]))
            self.accepts.append(best)
        return self.numbers[key]

    def _step(self, number: int, c: str) -> int:
        out: dict = {}

        def reach(node, edits):
            if edits < out.get(node, 99):
                out[node] = edits

        for node, edits in self.sets[number].items():
            if isinstance(node, str):
                reach(node, edits)
                continue
            if self.stem[node] and edits <= self.stem[node][1]:
                reach(self.stem[node][0], edits)  # any ending may follow
            if edits + 1 <= self.room[node]:
                reach(node, edits + 1)
            for letter, child in self.children[node].items():
                cost = edits + (letter != c)
                if cost <= self.room[child]:
                    reach(child, cost)
        result = self.moves[number][c] = self._number(self._closed(out))
        return result

    def match(self, word: str) -> tuple[str, int] | None:
        """The closest entry and its edits, or None."""
        if len(self.sets) > self.most_states:
            self._reset()
        state, moves = 1, self.moves
        for c in word:
            following = moves[state].get(c)
            state = self._step(state, c) if following is None else following
            if not state:
                return None
        return self.accepts[state]


def _word(x: str) -> str | None:
    w = x.strip(_STRIP)
    return w if len(w) >= 4 and w.isalpha() else None


def most_edits(term: str) -> int:
    return sum(len(term) >= least for least in EDITS)


def _starts(word: str) -> list[str]:
    return [word[:n] for n in STEM_LENGTHS if len(word) >= n]


def _paired(places: np.ndarray, starts: list[list[str]]) -> set[str]:
    """Starts that two different words within NEAR words have; places ascend, and starts are those of the word at each, the last the word itself."""
    last: dict[str, tuple[int, str, int]] = {}  # the latest place, its word, and the latest place of another word
    out = set()
    for at, own in zip(places.tolist(), starts):
        for k in own[:-1]:
            before, word, other = last.get(k, (-1 << 40, "", -1 << 40))
            other = other if word == own[-1] else before
            if at - other <= NEAR:
                out.add(k)
            last[k] = (at, own[-1], other)
    return out


def select_terms(rows: Iterable[tuple[str, int]], min_families: int = MIN_FAMILIES, precision: float = PRECISION, seed: Iterable[str] = ()) -> tuple[dict[str, int], dict[str, int], list[str]]:
    """Terms and stems, each with the edits it allows, and paired stems, of a sample of (text, toxic) and the seed."""
    known: dict[str | None, int] = {None: -1}
    normal = Bounded(_word)
    held = []
    for text, label in rows:
        words = [normal[x] for x in text.lower().split()] if text else []
        ids = np.fromiter((known.setdefault(w, len(known) - 1) for w in words), np.int32, len(words))
        own = np.unique(ids[ids >= 0])
        if len(own):
            held.append((ids, own, label))
    words = [w for w in known if w is not None]
    hashes = np.fromiter(map(hash64, words), np.uint64, len(words))
    held = [(ids, own, int(hashes[own].min()), label) for ids, own, label in held]
    toxic: dict[str, set] = defaultdict(set)
    paired: dict[str, set] = defaultdict(set)
    endings: dict[str, set] = defaultdict(set)
    for ids, own, family, label in held:
        if label:
            for w in map(words.__getitem__, own.tolist()):
                toxic[w].add(family)
                for k in _starts(w):
                    toxic[k + "*"].add(family)
                    if len(w) > len(k):
                        endings[k + "*"].add(w)
            at = np.flatnonzero(ids >= 0)
            for k in _paired(at, [[*_starts(words[i]), words[i]] for i in ids[at].tolist()]):
                paired[k].add(family)
    toxic = {k: v for k, v in toxic.items() if len(v) >= min_families}
    paired = {k: v for k, v in paired.items() if len(v) >= min_families}
    clean: dict[str, set] = defaultdict(set)
    clean_paired: dict[str, set] = defaultdict(set)
    possible = [[k for k in _starts(w) if k in paired] for w in words]
    some = np.array([bool(k) for k in possible] or [False])
    for ids, own, family, label in held:
        if not label:
            for w in map(words.__getitem__, own.tolist()):
                for k in (w, *(k + "*" for k in _starts(w))):
                    if k in toxic:
                        clean[k].add(family)
            at = np.flatnonzero((ids >= 0) & some[ids])
            for k in _paired(at, [[*possible[i], words[i]] for i in ids[at].tolist()]):
                clean_paired[k].add(family)
    good = {k for k, v in toxic.items() if len(v) >= precision * (len(v) + len(clean[k]))}
    stems: list[str] = []
    for k in sorted((k for k in good if k.endswith("*") and len(endings[k]) >= min_families), key=lambda k: (len(k), k)):
        # A stem must itself be what is toxic: several endings, none of which carries it alone.
        most = max(len(toxic.get(w, ())) for w in endings[k])
        if len(endings[k]) >= MIN_ENDINGS and most < 0.5 * len(toxic[k]) and not any(k.startswith(s) for s in stems):
            stems.append(k[:-1])
    company: list[str] = []
    for k in sorted((k for k, v in paired.items() if len(v) >= precision * (len(v) + len(clean_paired[k]))), key=lambda k: (len(k), k)):
        if not any(k.startswith(s) for s in (*stems, *company)):
            company.append(k)
    allowed = {t: most_edits(t) for t in {*(k for k in good if not k.endswith("*")), *seed}}
    within = {s: most_edits(s) for s in stems}
    matcher, clean_families, reached = Matcher(allowed, within), set(), defaultdict(set)
    closest = [matcher.match(w) for w in words]
    for _, own, family, label in held:
        if not label:
            clean_families.add(family)
            for hit in filter(None, map(closest.__getitem__, own.tolist())):
                reached[hit].add(family)
    for entries in (allowed, within):
        for term in entries:
            noisy = (e for e in range(1, entries[term] + 1) if len(reached[term, e]) > NOISE * len(clean_families))
            entries[term] = next(noisy, entries[term] + 1) - 1
    return allowed, within, company


def mine_lexicon(docs: DataFrame, labels: DataFrame, seed: Iterable[str] = SEED, max_rows: int = MAX_ROWS, max_chars: int = MAX_CHARS) -> tuple[dict[str, int], dict[str, int], list[str]]:
    """Terms and stems with the edits they allow, and paired stems."""
    seed = tuple(seed)
    ship(docs.sparkSession)
    chosen = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
        .where("doc_id is not null and label in (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where("label = other")
        .select("doc_id", "label")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    rows = documents(docs).where("text <> ''").join(F.broadcast(chosen), "doc_id").select("text", "label", "doc_id").repartition(1)  # at most max_rows rows of 12 bytes
    rows = rows.sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"), "text")

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, stems, company = select_terms(within_bound(batches), seed=seed)
        edits = [*terms.values(), *(-1 - e for e in stems.values()), *([-99] * len(company))]
        yield pa.RecordBatch.from_arrays([pa.array([*terms, *stems, *company], pa.string()), pa.array(edits, pa.int32())], ["entry", "edits"])

    def within_bound(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int]]:
        chars = 0
        for batch in sliced(batches, 64):
            for text, label in zip(texts_of(batch), batch.column(1).to_pylist()):
                if chars + len(text) <= max_chars:
                    chars += len(text)
                    yield text, label

    found = rows.mapInArrow(select, "entry string, edits int").collect()
    terms = {t: most_edits(t) for t in seed} | {r["entry"]: r["edits"] for r in found if r["edits"] >= 0}
    return terms, {r["entry"]: -1 - r["edits"] for r in found if -99 < r["edits"] < 0}, [r["entry"] for r in found if r["edits"] == -99]


class Scorer:
    def __init__(self, terms: dict[str, int], stems: dict[str, int], paired: Iterable[str] = ()):
        self.paired = frozenset(paired)
        self.matcher = Matcher(terms, {p: 0 for p in self.paired} | stems)
        self.found: list[tuple[str, int] | None] = [None]
        self.index: dict[tuple[str, int], int] = {}
        self.memo = Bounded(self._look, 500_000)

    def _look(self, word: str) -> int:
        hit = self.matcher.match(word.strip(_STRIP))
        if hit is None:
            return 0
        if hit not in self.index:
            self.index[hit] = len(self.found)
            self.found.append(hit)
        return self.index[hit]

    def weight(self, words: list[str], k: int, edits: int) -> float:
        before, after = words[max(0, k - WINDOW) : k], words[k + 1 : k + 1 + WINDOW]
        near = {w.strip(_STRIP) for w in (*before, *after)}
        left, word, right = " ".join(before), words[k], " ".join(after)
        core = word.strip(_STRIP)
        at = word.find(core)
        left, right = f"{left} {word[:at]}", f"{word[at + len(core) :]} {right}"
        quoted = len(_QUOTES.findall(left)) % 2 == 1 and len(_QUOTES.findall(right)) % 2 == 1
        weight = _BY_EDITS[edits]
        if quoted:
            weight *= 0.4
        if near & _REPORT:
            weight *= 0.6
        if near & _ADDRESS and not quoted:
            weight = 1 - (1 - weight) * 0.6
        return weight

    @staticmethod
    def _together(at: list[int], words: list[str]) -> set[int]:
        """The places of hits with a hit of another word near."""
        out = set()
        for places in (at, at[::-1]):
            other = before = None
            for k in places:
                if before is not None and words[before].strip(_STRIP) != words[k].strip(_STRIP):
                    other = before
                if other is not None and abs(k - other) <= NEAR:
                    out.add(k)
                before = k
        return out

    def score(self, text: str) -> tuple[float, list[str]]:
        words = text.lower().split()
        codes = np.fromiter(map(self.memo.__getitem__, words), np.int32, len(words))
        rest, terms = 1.0, []
        at = np.flatnonzero(codes).tolist()
        together = self._together(at, words) if self.paired else set()
        for k in at:
            term, edits = self.found[codes[k]]
            if term in self.paired and k not in together:
                continue
            rest *= 1 - self.weight(words, k, edits)
            terms.append(term)
        return round(1 - rest, 6), sorted(set(terms))


def score_toxicity(docs: DataFrame, labels: DataFrame | None = None, seed: Iterable[str] = SEED, max_rows: int = MAX_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, toxic, terms) of every document."""
    lexicon = mine_lexicon(docs, labels, seed, max_rows) if labels is not None else ({t: most_edits(t) for t in seed}, {}, [])
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)  # grows with the language, not the corpus
    held: list[Scorer] = []

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not held:
            held.append(Scorer(*shared.value))
        found = [(None, None) if t is None else held[0].score(t) for t in texts_of(batch)]
        scores = [s for s, _ in found]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(scores, pa.float64()), pa.array([s is not None and s >= threshold for s in scores], pa.bool_()), pa.array([t for _, t in found], pa.list_(pa.string()))],
            ["doc_id", "score", "toxic", "terms"],
        )

    return map_batches(documents(docs), work, "doc_id bigint, score double, toxic boolean, terms array<string>")

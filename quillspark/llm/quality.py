"""Quality classifier: hashed word n-gram logistic regression, trained by follow-the-regularised-leader.

Features are hashed into ``2**BITS`` weights: words, word pairs, and pairs of word shapes (case, digits, trailing
signs, whether the word repeats the one before). A text's features are weighted by count over its
length, so the score of a text is a sparse dot product through the logistic function, however long the text is.

Training takes at most ``max_rows`` labelled documents and ``max_chars`` characters of them, in order of the hash of doc_id (the one bounded
sample; both are parameters), and runs in one task; the rest of the engine sees only the weights. Labels that are null or that
disagree for a doc_id are left out. Without labelled rows of both classes no document is rejected.

Defined results: null and empty texts score null and are kept (there is nothing to judge); null doc_ids and repeated
rows are scored like any others; other columns are ignored by :func:`score` and kept by :func:`keep_good`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import Bounded, documents, hash64, map_batches, mix, ship, sliced, texts_of, word_hashes

BITS = 18
MAX_ROWS = 8000
#: Characters of labelled texts that are trained on at most; a text that would go beyond is left out whole. About 6 bytes of memory each.
MAX_CHARS = 64_000_000
THRESHOLD = 0.5
EPOCHS = 4
_SCALE = 30.0
_TAIL = re.compile(r"[^\w\s]*$")


def _shape(word: str) -> int:
    core, tail = word.strip("\"'“”‘’«»([{)]}"), _TAIL.search(word)[0][:3]
    letters = [c for c in core if c.isalpha()]
    case = "none" if not letters else "upper" if len(letters) > 1 and all(c.isupper() for c in letters) else "title" if letters[0].isupper() else "lower" if all(not c.isupper() for c in letters) else "mixed"
    return hash64(f"{case}\x1f{tail}\x1f{any(c.isdigit() for c in core)}\x1f{len(core) > 20}")


_SHAPES = Bounded(_shape)
_SAME = np.uint64(hash64("\x1fsame"))


def features(text: str) -> np.ndarray:
    """Indices of all features of a text, repeated as often as they occur."""
    words = text.split()
    n = len(words)
    if not n:
        return np.zeros(0, np.int64)
    h = word_hashes(words)
    s = np.fromiter(map(_SHAPES.__getitem__, words), np.uint64, n)
    s[1:][h[1:] == h[:-1]] = _SAME
    with np.errstate(over="ignore"):
        pairs = mix(h[:-1] * np.uint64(3) + h[1:])
        shapes = mix(s[:-1] * np.uint64(5) + s[1:])
    return (np.concatenate([h, pairs, s, shapes]) >> np.uint64(64 - BITS)).astype(np.int64)


class Ftrl:
    """FTRL-proximal logistic regression with per-coordinate rates."""

    def __init__(self, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.01):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n, self.bias_z, self.bias_n = np.zeros(1 << BITS), np.zeros(1 << BITS), 0.0, 0.0

    def _weights(self, z, n):
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def bias(self) -> float:
        return -self.bias_z / ((self.beta + np.sqrt(self.bias_n)) / self.alpha)

    def learn(self, index: np.ndarray, value: np.ndarray, label: int, weight: float = 1.0) -> None:
        z, n = self.z[index], self.n[index]
        w, b = self._weights(z, n), self.bias()
        p = 1 / (1 + np.exp(-np.clip(w @ value + b, -35, 35)))
        e = weight * (p - label)
        g = e * value
        self.z[index] = z + g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[index] = n + g * g
        self.bias_z += e - (np.sqrt(self.bias_n + e * e) - np.sqrt(self.bias_n)) / self.alpha * b
        self.bias_n += e * e

    def weights(self) -> np.ndarray:
        return self._weights(self.z, self.n)


def _sparse(text: str) -> tuple[np.ndarray, np.ndarray]:
    index, counts = np.unique(features(text), return_counts=True)
    return index, counts * (_SCALE / max(1, counts.sum()))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, max_chars: int = MAX_CHARS) -> tuple[np.ndarray, float]:
    """Weights and bias from a bounded sample of the labelled documents."""
    ship(docs.sparkSession)
    chosen = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("label"))
        .where("doc_id is not null and label in (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where("label = other")
        .select("doc_id", "label")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    rows = documents(docs).where("text <> ''").join(F.broadcast(chosen), "doc_id")  # at most max_rows rows of 12 bytes
    rows = rows.select("label", "text", "doc_id").repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), F.xxhash64("text"), "text", "label")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, chars = [], 0
        for batch in sliced(batches, 64):
            for label, text in zip(batch.column(0).to_pylist(), texts_of(batch)):
                if chars + len(text) > max_chars:
                    continue
                chars += len(text)
                index, value = _sparse(text)
                held.append((label, index.astype(np.int32), value.astype(np.float32)))
        bad = sum(1 for label, _, _ in held if label == 0)
        if not bad or bad == len(held):
            return
        model, weight = Ftrl(), (len(held) - bad) / bad
        for epoch in range(EPOCHS):
            for k in np.random.default_rng(epoch).permutation(len(held)):
                label, index, value = held[k]
                model.learn(index, value.astype(np.float64), label, 1.0 if label else min(4.0, weight))
        w = model.weights()
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(w[at], model.bias()), pa.float64())], ["at", "weight"])

    w, bias = np.zeros(1 << BITS, np.float32), 0.0
    for r in rows.mapInArrow(fit, "at int, weight double").collect():  # at most 2**BITS weights
        if r["at"] < 0:
            bias = r["weight"]
        else:
            w[r["at"]] = r["weight"]
    return w, bias


def _scored(docs: DataFrame, model: tuple[np.ndarray, float]):
    shared, bias = docs.sparkSession.sparkContext.broadcast(model[0]), model[1]
    none = not model[0].any() and bias == 0.0

    def probability(text: str | None) -> float | None:
        if not text or none or not len(index := features(text)):
            return None
        x = float(shared.value[index].sum(dtype=np.float64)) * _SCALE / len(index) + bias
        return float(1 / (1 + np.exp(-np.clip(x, -35, 35))))

    return probability


def score(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, keep): the probability of good quality, and whether it reaches the threshold."""
    probability = _scored(docs, train(docs, labels, max_rows))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [probability(t) for t in texts_of(batch)]
        keep = [p is None or p >= threshold for p in found]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64()), pa.array(keep, pa.bool_())], ["doc_id", "score", "keep"])

    return map_batches(documents(docs), work, "doc_id bigint, score double, keep boolean")


def keep_good(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, with all their columns, whose text is not rejected."""
    probability = _scored(docs, train(docs, labels, max_rows))
    at = docs.columns.index("text")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept = [p is None or p >= threshold for p in map(probability, batch.column(at).to_pylist())]
        return batch.filter(pa.array(kept, pa.bool_()))

    return map_batches(docs, work, docs.schema)

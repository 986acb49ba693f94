"""LM scoring: a log-bilinear model trained in numpy by noise-contrastive estimation.

The model predicts a representation as a sum of the two predecessors' representations, each scaled
component by component, and scores by dot products with that prediction plus a bias.

Vocabulary: words are counted over all documents, and words at or above a frequency have parameters of their own: the lowest frequency that at most
:func:`vocabulary_size` words reach, a number that grows with the root of the corpus. Other words are one class, UNKNOWN, told apart by spelling.

Words in order of frequency are cut into about as many classes as a class has words. A word's probability is that of its
class times that of the word within its class, both log-bilinear in the same prediction. So the normaliser of a token is two sums of a root of the
vocabulary's size each, and batched matrix products give the normalised log-probabilities of all tokens of a batch: one product
with all classes, and for each class one of its tokens with its words. Nothing is the size of the vocabulary squared.

Training reads every document once, in ``ROUNDS`` rounds: in each, every task runs minibatches of noise-contrastive estimation over its share
of the round, starting from the same parameters; noise classes come by their frequency, noise words by theirs within the class. A task
returns what has changed for the words that it has seen, in blocks, and changes are averaged by occurrences. So what is gathered grows with the
corpus, and no task holds more than a batch and the parameters. Since tasks are averaged, scores depend a little on how the table is split.

Scoring: a word of the class UNKNOWN has the class's probability times that of its spelling among unknown words: a byte trigram model of all
counted words outside the vocabulary, by their counts, without the mass it gives to words of the vocabulary.

Defined results: null texts score null; a text without words predicts only its end; null doc_ids and repeated rows count and are scored
like others; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import cut, documents, map_batches, ship, sliced, texts_of

#: Least and most words with parameters of their own (bytes that are sent to the executors: 260 for each), and words for each root of the number of tokens.
LEAST_WORDS, MOST_WORDS, PER_ROOT = 8192, 1 << 18, 1.0
DIMENSIONS = 32
#: Noise classes for a batch, and noise words for each class of a batch.
NOISE, NOISE_WORDS = 16, 8
ROUNDS = 3
BATCH = 16_384
RATE = 0.06
UNKNOWN, EDGE = 0, 1
_MOST_COUNTED = 400_000
_BLOCK = 256


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n) over all documents; counts are combined in each task before they move."""
    ship(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in sliced(batches):
            for text in texts_of(batch):
                if text:
                    held.update(text.lower().split())
            if len(held) > _MOST_COUNTED:
                yield rows(held)
                held = Counter()
        if held:
            yield rows(held)

    def rows(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

    return docs.select("doc_id", "text").mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary_size(tokens: int) -> int:
    return int(min(MOST_WORDS, max(LEAST_WORDS, PER_ROOT * tokens**0.5)))


def choose_vocabulary(docs: DataFrame, size: int | None = None) -> tuple[list[str], np.ndarray]:
    """The most frequent words after the two special ones, and the relative frequency of each."""
    return _vocabulary(cut(count_words(docs)), size)


def _vocabulary(counts: DataFrame, size: int | None) -> tuple[list[str], np.ndarray]:
    # Frequencies in steps of a sixteenth of a doubling: a few hundred rows, whatever the corpus.
    step = F.floor(16 * F.log2("n"))
    steps = counts.groupBy(step.alias("step")).agg(F.count("*").alias("words"), F.sum("n").alias("n")).collect()
    total = sum(r["n"] for r in steps)
    size, lowest, reached = size or vocabulary_size(total), 1 << 30, 2
    for r in sorted(steps, key=lambda r: -r["step"]):
        reached += r["words"]
        if reached > size:
            break
        lowest = r["step"]
    top = sorted(counts.where(step >= lowest).collect(), key=lambda r: (-r["n"], r["word"]))  # at most size words
    words = ["\x00unknown", "\x00edge", *(r["word"] for r in top)]
    known = np.array([r["n"] for r in top], np.float64)
    frequency = np.concatenate([[max(1.0, total - known.sum()), max(1.0, total / 100)], known])
    return words, frequency / frequency.sum()


_BOUND = 255  # no byte of UTF-8
#: Weight of the shorter context where a longer one is rare.
_BACK = 5.0


def _trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Byte trigrams of words that hold no white space, each word with two bounds before it and one after, as a row of three; where each word's rows begin."""
    x = np.frombuffer(("\n".join(words) + "\n").encode(), np.uint8).copy()
    ends = x == 10
    x[ends] = _BOUND
    before = np.concatenate([[_BOUND], x[:-1]]).astype(np.uint8)
    first = np.concatenate([[_BOUND], before[:-1]]).astype(np.uint8)
    first[before == _BOUND] = _BOUND
    return np.stack([first, before, x], 1), np.concatenate([[0], np.flatnonzero(ends)[:-1] + 1])


def count_trigrams(counts: DataFrame, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of the byte trigrams of all counted words outside the vocabulary; there are never more than 2 ** 24."""
    ship(counts.sparkSession)
    known = counts.sparkSession.sparkContext.broadcast(frozenset(words))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(w, n) for w, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if w not in known.value]
            if not found:
                continue
            rows, starts = _trigrams([w for w, _ in found])
            weights = np.repeat(np.array([n for _, n in found], np.int64), np.diff(np.append(starts, len(rows))))
            codes, at = np.unique((rows.astype(np.int32) << np.array([16, 8, 0], np.int32)).sum(1, dtype=np.int32), return_inverse=True)
            sums = np.zeros(len(codes), np.int64)
            np.add.at(sums, at, weights)
            yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(sums)], ["code", "n"])

    found = counts.select("word", "n").mapInArrow(count, "code int, n bigint").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    return found["code"].to_numpy(), found["n"].to_numpy()


class Spelling:
    """Log-probabilities of words among those outside the vocabulary; every string has one, also if it was never counted."""

    def __init__(self, codes: np.ndarray, n: np.ndarray, words: list[str]):
        parts = [(codes >> 16) & 255, (codes >> 8) & 255, codes & 255]
        seen = np.unique(np.concatenate([[_BOUND], *parts]))
        size, rest = len(seen) + 1, 256 - len(seen)  # the last is any byte that was never seen
        self.place = np.full(256, size - 1, np.intp)
        self.place[seen] = np.arange(len(seen))
        a, b, c = (self.place[x] for x in parts)
        one = np.bincount(c, n, size) + 1.0
        one[-1] = rest
        one /= one.sum()
        two = np.bincount(b * size + c, n, size * size).reshape(size, size)
        two = (two + _BACK * one) / (two.sum(1, keepdims=True) + _BACK)
        self.table = np.empty((size, size, size), np.float32)
        order = np.argsort(a, kind="stable")
        bounds = np.searchsorted(a[order], np.arange(size + 1))
        for k in range(size):
            own = order[bounds[k] : bounds[k + 1]]
            three = np.bincount(b[own] * size + c[own], n[own], size * size).reshape(size, size)
            self.table[k] = np.log((three + _BACK * two) / (three.sum(1, keepdims=True) + _BACK))
        self.table[:, :, -1] -= np.log(max(1, rest))
        self.left = 0.0
        # The empty string is no word either.
        taken = float(np.exp(self.log_probabilities(words)).sum() + np.exp(self.table[(self.place[_BOUND],) * 3]))
        self.left = float(np.log(max(1e-9, 1 - taken)))

    def log_probabilities(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros(0)
        rows, starts = _trigrams(words)
        a, b, c = self.place[rows].T
        return np.add.reduceat(self.table[a, b, c].astype(np.float64), starts) - self.left


class Model:
    """words: for each word its context representation r, target representation q and bias b; scales of the two positions; classes: s and biases t.

    Class k has the words from ``k * width`` on.
    """

    def __init__(self, words: np.ndarray, scales: np.ndarray, s: np.ndarray, t: np.ndarray):
        d = s.shape[1]
        self.words, self.scales, self.s, self.t, self.width = words, scales, s, t, class_width(len(words))
        self.r, self.q, self.b = words[:, :d], words[:, d : 2 * d], words[:, 2 * d]
        self._with_bias: tuple | None = None

    @classmethod
    def fresh(cls, frequency: np.ndarray, dimensions: int = DIMENSIONS, seed: int = 5) -> Model:
        rng, v, d = np.random.default_rng(seed), len(frequency), dimensions
        of_class = class_frequency(frequency)
        words = rng.normal(0, 0.3, (v, 2 * d + 1)).astype(np.float32)
        words[:, d : 2 * d] *= np.float32(0.3)
        words[:, 2 * d] = np.log(frequency / of_class[np.arange(v) // class_width(v)])
        return cls(words, np.full((2, d), 0.5, np.float32), rng.normal(0, 0.1, (len(of_class), d)).astype(np.float32), np.log(of_class).astype(np.float32))

    def dense(self) -> np.ndarray:
        """What does not belong to a word."""
        return np.concatenate([self.scales.ravel(), self.s.ravel(), self.t])

    def with_dense(self, flat: np.ndarray) -> Model:
        d, k = self.s.shape[1], len(self.t)
        scales, s, t = np.split(flat.astype(np.float32), [2 * d, 2 * d + k * d])
        return Model(self.words.copy(), scales.reshape(2, d).copy(), s.reshape(k, d).copy(), t.copy())

    def copy(self) -> Model:
        return Model(self.words.copy(), self.scales.copy(), self.s.copy(), self.t.copy())

    def log_probabilities(self, w1: np.ndarray, w2: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Normalised log-probability of each w after w1, w2."""
        if self._with_bias is None:  # biases as a last column, for a context whose last component is one
            self._with_bias = np.column_stack([self.s, self.t]).T.copy(), np.column_stack([self.q, self.b])
        classes, words = self._with_bias
        order = np.argsort(_small(w // self.width), kind="stable")
        w1, w2, w = w1[order], w2[order], w[order]
        context = np.ones((len(w), classes.shape[0]), classes.dtype)
        context[:, :-1] = self.scales[0] * self.r[w1] + self.scales[1] * self.r[w2]
        k = w // self.width
        out = np.empty(len(w))
        out[order] = _chosen(context @ classes, k)
        begins = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else k
        for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(k)]):
            first = int(k[a]) * self.width
            out[order[a:b]] += _chosen(context[a:b] @ words[first : first + self.width].T, w[a:b] - first)
        return out


def class_width(v: int) -> int:
    """Words of a class, for about as many classes."""
    return int(np.ceil(v**0.5))


def class_frequency(frequency: np.ndarray) -> np.ndarray:
    return np.add.reduceat(frequency, np.arange(0, len(frequency), class_width(len(frequency))))


def _small(x: np.ndarray) -> np.ndarray:
    """Numbers in two bytes where they fit, which sort faster."""
    return x.astype(np.uint16) if not len(x) or x.max() < 65_536 else x


def _chosen(scores: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Row by row, the chosen score less the logarithm of the sum of exponentials; scores are used up."""
    picked = scores[np.arange(len(scores)), chosen].astype(np.float64)
    if len(scores) and max(scores.max(), -scores.min()) > 60:  # sums that may be too large or too small
        top = scores.max(1)
        return picked - top - np.log(np.exp(scores - top[:, None]).sum(1, dtype=np.float64))
    sums = np.exp(scores, out=scores) @ np.ones(scores.shape[1], scores.dtype)
    return picked - np.log(sums.astype(np.float64))


def _sums(index: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct indices and the sum of the rows of each."""
    order = np.argsort(_small(index), kind="stable")
    index = index[order]
    begins = np.flatnonzero(np.r_[True, index[1:] != index[:-1]])
    return index[begins], np.add.reduceat(rows[order], begins, axis=0)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    out = np.clip(x, -30, 30)
    np.negative(out, out=out)
    np.exp(out, out=out)
    out += 1
    return np.reciprocal(out, out=out)


class Noise:
    """Draws noise classes by frequency and noise words by frequency within each class, and knows the logarithms of their rates."""

    def __init__(self, frequency: np.ndarray, classes: int = NOISE, words: int = NOISE_WORDS, seed: int = 0):
        self.classes, self.words, self.rng = classes, words, np.random.default_rng(seed)
        of_class, self.width = class_frequency(frequency), class_width(len(frequency))
        self.first = np.arange(0, len(frequency), self.width)
        self.of_class, self.edges = np.cumsum(of_class), np.cumsum(frequency)
        self.low, self.mass = self.edges[self.first] - frequency[self.first], of_class
        self.prior_class = np.log(classes * of_class).astype(np.float32)
        self.prior_word = np.log(words * frequency / of_class[np.arange(len(frequency)) // self.width]).astype(np.float32)

    def draw(self) -> tuple[np.ndarray, np.ndarray]:
        """Classes, and for each class words of its own."""
        k = np.minimum(np.searchsorted(self.of_class, self.rng.random(self.classes) * self.of_class[-1]), len(self.first) - 1)
        at = np.searchsorted(self.edges, self.low[:, None] + self.rng.random((len(self.first), self.words)) * self.mass[:, None])
        return k, np.clip(at, self.first[:, None], np.minimum(self.first + self.width, len(self.edges))[:, None] - 1)


def contrast(m: Model, noise: Noise, w1: np.ndarray, w2: np.ndarray, w: np.ndarray, bad: np.ndarray, bad_words: np.ndarray, measured: bool = False) -> tuple[float, dict]:
    """The objective (if measured) of a batch against noise classes and words, and its gradient: dense parts whole, those of words as (words, rows)."""
    order = np.argsort(_small(w), kind="stable")
    w1, w2, w = w1[order], w2[order], w[order]
    r1, r2, k = m.r[w1], m.r[w2], w // m.width
    context = m.scales[0] * r1 + m.scales[1] * r2
    begins = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
    pieces = list(zip(begins.tolist(), [*begins[1:].tolist(), len(w)], k[begins].tolist()))
    noisy = bad_words[k[begins]]
    q_noisy = m.q[noisy]
    sk, qw = m.s[k], m.q[w]
    good = np.einsum("ij,ij->i", context, sk) + (m.t - noise.prior_class)[k]
    wrong = context @ m.s[bad].T + (m.t[bad] - noise.prior_class[bad])
    good_word = np.einsum("ij,ij->i", context, qw) + (m.b - noise.prior_word)[w]
    wrong_word = np.empty((len(w), bad_words.shape[1]), context.dtype)
    level = m.b[noisy] - noise.prior_word[noisy]
    for n, (a, e, _) in enumerate(pieces):
        np.matmul(context[a:e], q_noisy[n].T, out=wrong_word[a:e])
        wrong_word[a:e] += level[n]
    objective = sum(float(np.log(_sigmoid(x)).sum(dtype=np.float64)) for x in (good, -wrong, good_word, -wrong_word)) if measured else 0.0
    good, wrong, good_word, wrong_word = _sigmoid(-good), -_sigmoid(wrong), _sigmoid(-good_word), -_sigmoid(wrong_word)
    dcontext = good[:, None] * sk
    dcontext += wrong @ m.s[bad]
    dcontext += good_word[:, None] * qw
    width = context.shape[1]
    dq_noisy = np.empty((*noisy.shape, width + 1), context.dtype)
    for n, (a, e, _) in enumerate(pieces):
        dcontext[a:e] += wrong_word[a:e] @ q_noisy[n]
        np.matmul(wrong_word[a:e].T, context[a:e], out=dq_noisy[n, :, :width])
    dq_noisy[:, :, width] = np.add.reduceat(wrong_word, begins, axis=0)
    ds, dt = np.zeros_like(m.s), np.zeros_like(m.t)
    ds[k[begins]] = np.add.reduceat(good[:, None] * context, begins, axis=0)
    dt[k[begins]] = np.add.reduceat(good, begins)
    np.add.at(ds, bad, wrong.T @ context)
    np.add.at(dt, bad, wrong.sum(0))
    # Targets are in order already.
    first = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
    dq = np.add.reduceat(np.column_stack([good_word[:, None] * context, good_word]), first, axis=0)
    q = _sums(np.concatenate([w[first], noisy.ravel()]), np.concatenate([dq, dq_noisy.reshape(-1, width + 1)]))
    # Each position's sums before its scale: a word's gradient is scaled once, not at each of its places.
    (at1, x1), (at2, x2) = _sums(w1, dcontext), _sums(w2, dcontext)
    r = _sums(np.concatenate([at1, at2]), np.concatenate([x1 * m.scales[0], x2 * m.scales[1]]))
    dscales = np.stack([np.einsum("ij,ij->j", dcontext, r1), np.einsum("ij,ij->j", dcontext, r2)])
    return objective, {"scales": dscales, "s": ds, "t": dt, "r": r, "q": q}


class Trainer:
    """Noise-contrastive estimation with AdaGrad; a batch shares its noise."""

    def __init__(self, model: Model, frequency: np.ndarray, rate: float = RATE, seed: int = 0):
        self.m, self.noise, self.rate = model, Noise(frequency, seed=seed), rate
        self.squares = Model(*(np.full(x.shape, 1e-2, np.float32) for x in (model.words, model.scales, model.s, model.t)))
        self.seen = np.zeros(len(frequency), np.int64)

    def step(self, w1: np.ndarray, w2: np.ndarray, w: np.ndarray) -> None:
        _, g = contrast(self.m, self.noise, w1, w2, w, *self.noise.draw())
        scale, d = np.float32(1 / np.sqrt(len(w))), self.m.s.shape[1]
        for name in ("scales", "s", "t"):
            own, x = getattr(self.squares, name), g[name] * scale
            own += x * x
            getattr(self.m, name)[...] += self.rate * x / np.sqrt(own)
        for name, columns in (("r", slice(0, d)), ("q", slice(d, 2 * d + 1))):
            at, x = g[name][0], g[name][1] * scale
            own = self.squares.words[at, columns] + x * x
            self.squares.words[at, columns] = own
            self.m.words[at, columns] += self.rate * x / np.sqrt(own)
        self.seen += np.bincount(np.concatenate([w1, w2, w]), minlength=len(self.seen))


def numbers(words: list[str]) -> dict[str, int]:
    """Identifiers of the words of a vocabulary."""
    return {w: k for k, w in enumerate(words)}


def word_ids(words: list[str], known: dict[str, int]) -> np.ndarray:
    """Identifiers of a text's words between two edges before and one after."""
    out = np.full(len(words) + 3, EDGE, np.int32)
    out[2:-1] = np.fromiter(map(known.get, words, repeat(UNKNOWN)), np.int32, len(words))
    return out


_CHANGES = pa.schema([("block", pa.int32()), ("ids", pa.binary()), ("seen", pa.binary()), ("change", pa.binary())])
_CHANGES_DDL = "block int, ids binary, seen binary, change binary"


def _changes(trainer: Trainer, start: Model) -> pa.RecordBatch:
    """What a task has learned about the words it has seen, in blocks; block -1 is what belongs to no word."""
    total = np.array([trainer.seen.sum()], np.int64)
    rows = [(-1, b"", total.tobytes(), (trainer.m.dense() - start.dense()).tobytes())]
    at = np.flatnonzero(trainer.seen)
    for part in np.split(at, np.flatnonzero(np.diff(at // _BLOCK)) + 1):
        rows.append((int(part[0]) // _BLOCK, part.astype(np.int32).tobytes(), trainer.seen[part].tobytes(), (trainer.m.words[part] - start.words[part]).tobytes()))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _CHANGES)], schema=_CHANGES)


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The changes of each block's words, averaged by how often each task has seen them."""
    sums: dict[int, list] = {}
    for batch in batches:
        for block, ids, seen, change in zip(*(c.to_pylist() for c in batch.columns)):
            at = np.frombuffer(ids, np.int32) - max(0, block) * _BLOCK if block >= 0 else np.zeros(1, np.int64)
            n, x = np.frombuffer(seen, np.int64), np.frombuffer(change, np.float32).reshape(len(at), -1)
            total = sums.setdefault(block, [np.zeros(_BLOCK, np.int64), np.zeros((_BLOCK, x.shape[1]))])
            total[0][at] += n
            total[1][at] += x.astype(np.float64) * n[:, None]
    rows = []
    for block, (n, x) in sums.items():
        at = np.flatnonzero(n)
        rows.append((block, (at + max(0, block) * _BLOCK).astype(np.int32).tobytes(), b"", (x[at] / n[at, None]).astype(np.float32).tobytes()))
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _CHANGES)], schema=_CHANGES)


def train(docs: DataFrame, words: list[str], frequency: np.ndarray, rounds: int = ROUNDS, dimensions: int = DIMENSIONS) -> Model:
    spark = docs.sparkSession
    ship(spark)
    model = Model.fresh(frequency, dimensions)
    known = spark.sparkContext.broadcast((words, frequency))
    texts = documents(docs).where("text is not null")
    for turn in range(rounds):
        start = spark.sparkContext.broadcast((model.words, model.scales, model.s, model.t))

        def learn(batches: Iterator[pa.RecordBatch], turn=turn, start=start) -> Iterator[pa.RecordBatch]:
            trainer, held, size, of = None, [], 0, numbers(known.value[0])
            for batch in sliced(batches, 64):
                trainer = trainer or Trainer(Model(*start.value).copy(), known.value[1], seed=turn)
                for text in texts_of(batch):
                    held.append(word_ids(text.lower().split(), of))
                    size += len(held[-1]) - 2
                if size >= BATCH:
                    learned(trainer, held)
                    held, size = [], 0
            if held:
                learned(trainer, held)
            if trainer:
                yield _changes(trainer, Model(*start.value))

        def learned(trainer: Trainer, held: list[np.ndarray]) -> None:
            w1, w2, w = (np.concatenate([x[k : len(x) - 2 + k] for x in held]) for k in range(3))
            for at in range(0, len(w), BATCH):
                trainer.step(w1[at : at + BATCH], w2[at : at + BATCH], w[at : at + BATCH])

        share = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(rounds)) == turn  # the other rounds read the rest
        found = texts.where(share).mapInArrow(learn, _CHANGES_DDL).repartition("block").mapInArrow(_averaged, _CHANGES_DDL).toArrow()
        model = model.copy()
        for block, ids, change in zip(*(found[c].to_pylist() for c in ("block", "ids", "change"))):  # one set of parameters
            if block < 0:
                model = model.with_dense(model.dense() + np.frombuffer(change, np.float32))
            else:
                at = np.frombuffer(ids, np.int32)
                model.words[at] += np.frombuffer(change, np.float32).reshape(len(at), -1)
        start.unpersist()
    return model


#: Tokens whose scores are held at once.
_SCORED = 16_384


def score_documents(docs: DataFrame, model: Model, words: list[str], spelt: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """(doc_id, n_words, log_prob, perplexity): log_prob sums over the words and the end, perplexity is per prediction.

    spelt: what :func:`count_trigrams` found; without it a word outside the vocabulary has the probability of its whole class.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.words, model.scales, model.s, model.t, words, spelt))
    held: list[tuple[Model, dict, Spelling | None]] = []  # one for each task

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not held:
            *parameters, vocabulary, trigrams = shared.value
            held.append((Model(*parameters), numbers(vocabulary), trigrams and Spelling(*trigrams, vocabulary[2:])))
        own, known, spelling = held[0]
        split = [None if t is None else t.lower().split() for t in texts_of(batch)]
        there = [x for x in split if x is not None]
        sums = iter(scored(there, own, known, spelling)) if there else iter(())
        logs = [None if x is None else float(next(sums)) for x in split]
        counts = [None if x is None else len(x) for x in split]
        perplexity = [None if n is None else float(np.exp(-x / (n + 1))) for n, x in zip(counts, logs)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int32()), pa.array(logs, pa.float64()), pa.array(perplexity, pa.float64())], ["doc_id", "n_words", "log_prob", "perplexity"])

    def scored(texts: list[list[str]], own: Model, known: dict, spelling: Spelling | None) -> np.ndarray:
        ids = [word_ids(x, known) for x in texts]
        w1, w2, w = (np.concatenate([x[k : len(x) - 2 + k] for x in ids]) for k in range(3))
        logs = np.concatenate([own.log_probabilities(w1[at : at + _SCORED], w2[at : at + _SCORED], w[at : at + _SCORED]) for at in range(0, len(w), _SCORED)])
        if spelling:
            unknown = np.flatnonzero(w == UNKNOWN)
            # The ends of texts are no words, and never unknown.
            logs[unknown] += spelling.log_probabilities([x for t, k in zip(texts, ids) for x in compress(t, k[2:-1] == UNKNOWN)])
        return np.add.reduceat(logs, np.cumsum([0, *(len(x) - 2 for x in ids[:-1])]))

    return map_batches(documents(docs), work, "doc_id bigint, n_words int, log_prob double, perplexity double")


def lm_scores(docs: DataFrame, size: int | None = None, rounds: int = ROUNDS) -> DataFrame:
    """Train on docs and score them."""
    texts = documents(docs)
    counts = cut(count_words(texts))
    words, frequency = _vocabulary(counts, size)
    return score_documents(docs, train(docs, words, frequency, rounds), words, count_trigrams(counts, words))

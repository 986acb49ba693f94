"""Reading of words for decontamination: most of them at once, all of them as one by one."""

import random

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("quillspark.llm", exc_type=ImportError)

from quillspark.llm import common, decontam  # noqa: E402

PARTS = ["Alice", "old", "12", "3.5kg", "km", "$5", "KG", "dollars", "Ende:", "Paris", "日本語", "é", "Éa", "ÄÖ", "aÑo", "año", "ß", "ÿ", "×", "÷", "İs", "K", "a", "A", "USA", "\x00", "​", "½", "٣", "don't", "−7", "°"]
MARKS = "\"'`“”‘’«».,;:!?()[]{}<>…*_~|#%&$€£-+°"
SPACES = [chr(c) for c in range(0x110000) if chr(c).isspace()]


def some_words(rng, n):
    marks = lambda most: "".join(rng.choice(MARKS) for _ in range(rng.randrange(most)))
    words = [marks(3) + "".join(rng.choice(PARTS) for _ in range(rng.randrange(3))) + marks(4) for _ in range(n)]
    return [w for w in words if w]


def some_text(rng):
    return "".join(w + "".join(rng.choice(SPACES) for _ in range(rng.randrange(1, 4))) for w in some_words(rng, rng.randrange(40)))


def test_plain_words_are_not_read_one_by_one(monkeypatch):
    rng, seen = random.Random(1), []
    made = common.Bounded.__missing__
    monkeypatch.setattr(common.Bounded, "__missing__", lambda self, key: seen.append(key) or made(self, key))
    plain = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzéèßñ", k=12)) + rng.choice(["", ".", ",", "!!"]) for _ in range(2000)]
    hashes, _, words = decontam.canonical(" ".join([*plain, "12", "naïve—word"]))
    assert words[: len(plain)] == plain and len(set(hashes.tolist())) > 1900
    assert len(seen) <= 2


def test_words_read_at_once_are_those_read_one_by_one():
    words = list(dict.fromkeys(some_words(random.Random(2), 20_000)))
    packed, _, _ = decontam._split([" ".join(words)])
    assert len(packed) == len(words)
    forth, back = {}, {}
    for word, own in zip(words, packed.tolist()):
        flags, inner = decontam._read(word.encode())
        assert own & 31 == flags and (own >> 5 > 0) == bool(inner), word
        assert forth.setdefault(own >> 5, inner) == inner and back.setdefault(inner, own >> 5) == own >> 5, word


def test_words_and_lines_are_those_of_python():
    rng = random.Random(3)
    texts = ["", " ", "\n", *(f"one{s}two{s} {s}three" for s in SPACES), *(some_text(rng) for _ in range(200)), "\x1a \x7f"]
    packed, begin, broken = decontam._split(texts)
    for text, at, stop in zip(texts, begin, [*begin[1:], len(packed)]):
        assert stop - at == len(text.split()), repr(text)
        lines = np.cumsum([len(line.split()) for line in text.splitlines()] or [0])
        assert set((np.flatnonzero(broken[at:stop][1:]) + 1).tolist()) == {k for k in lines.tolist() if 0 < k < stop - at}, repr(text)


@pytest.mark.parametrize("at_once", [decontam.CHARS_AT_ONCE, 60])
def test_documents_read_together_are_those_read_alone(monkeypatch, at_once):
    rng = random.Random(4)
    monkeypatch.setattr(decontam, "CHARS_AT_ONCE", at_once)
    every = decontam.Wanted(None, np.full(1 << 13, 255, np.uint8))
    texts = [None, "", " \n ", *(some_text(rng) for _ in range(80))]
    ids = [None if k % 9 == 8 else k for k in range(len(texts))]

    def rows(ids, texts):
        batch = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])
        return decontam._of_documents(batch, [3, 8], 1, every).to_pylist()

    together = rows(ids, texts)
    assert sorted(map(str, together)) == sorted(str(r) for i, t in zip(ids, texts) for r in rows([i], [t]))
    usable = {(i, k) for i, t in zip(ids, texts) if i is not None and t for k in np.flatnonzero(decontam._windows(decontam.canonical(t)[0], 8, 1)[1]).tolist()}
    assert {(r["id"], r["at"]) for r in together if r["reading"] == 0 and r["size"] == 8} == usable and len(usable) > 300

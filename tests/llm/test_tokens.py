"""Byte-level BPE: encoding, decoding and counting against public implementations and round trips."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillspark.llm import bpe

EDGE = [None, "", " ", "\n\n", "a", "naïve ﬁ½² ÿ", "日本語テキスト😀 emoji", "it's we'll 'twas", "  two  spaces\t\ttabs ", "\x1c\x85\xa0 odd", "x" * 30_000, "word " * 20_000, "é" * 5_000]


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(open(bpe.VOCABULARY, "rb").read())


@pytest.fixture(scope="module")
def public(codec):
    import public_tokenizers as P
    import tiktoken

    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=60))
def test_agrees_with_public_tokenizer(codec, public, text):
    want = public.encode_ordinary(text)
    assert list(codec.encode(text)) == want and codec.count(text) == len(want)
    assert codec.decoder.decode(want) == text


def test_plain_merging_agrees(codec):
    rng = random.Random(3)
    for _ in range(300):
        piece = bytes(rng.choice(b"abcdethe ingo") for _ in range(rng.randint(1, 25)))
        want = bpe.merge_tokens(codec.ranks, piece)
        assert tuple(codec.transducer.encode(piece)) == want and bpe.merge_count(codec.ranks, piece) == len(want)


def test_full_transducer_gives_the_same(codec, public):
    small = bpe.Transducer(codec.ranks, most_states=40)
    for word in "transformation unbelievable tokenisation xqzzt heedble thtion ".split() * 3:
        assert small.encode(word.encode()) == public.encode_ordinary(word)
    small.unkept = 10**9
    assert small.encode(b"again") == public.encode_ordinary("again") and small.unkept < 10**9


def test_lookahead_is_bounded(codec):
    for text in EDGE:
        codec.encode(text or "")
    assert codec.transducer.longest_delay < 16


def test_streaming_decoder_state(codec, public):
    text = "😀é日本 end"
    d = bpe.StreamingDecoder(codec.transducer.bytes_of)
    out = "".join(d.feed([t]) for t in public.encode_ordinary(text)) + d.finish()
    assert out == text
    byte = {v: k for k, v in codec.transducer.bytes_of.items()}
    for broken in (b"\xff", b"\xe6\x97", b"a\xc3(", b"\xed\xa0\x80", b"\xf0\x9f\x98"):
        d = bpe.StreamingDecoder(codec.transducer.bytes_of)
        assert d.feed([byte[bytes([b])] for b in broken]) + d.finish() == broken.decode("utf-8", "replace")


def test_tables(spark, public):
    rows = [(k, t, "x") for k, t in enumerate(EDGE)] + [(None, "null id", "x"), (1, "", "x"), (4, "a", "x"), (4, "a", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, tokens string")
    enc = bpe.encode_documents(docs)
    got = enc.collect()
    assert len(got) == len(rows) and all(r["round_trip"] for r in got if r["tokens"] is not None)
    by = {(r["doc_id"], tuple(r["tokens"]) if r["tokens"] is not None else None) for r in got}
    assert by == {(i, None if t is None else tuple(public.encode_ordinary(t))) for i, t, _ in rows}
    counts = sorted(((r["doc_id"], r["n_tokens"], r["n_bytes"]) for r in bpe.count_tokens(docs).collect()), key=str)
    assert counts == sorted(((i, None if t is None else len(public.encode_ordinary(t)), None if t is None else len(t.encode())) for i, t, _ in rows), key=str)
    back = sorted(((r["doc_id"], r["text"]) for r in bpe.decode_tokens(enc).collect()), key=str)
    assert back == sorted(((i, t) for i, t, _ in rows), key=str)
    empty = docs.limit(0)
    assert bpe.encode_documents(empty).count() == bpe.count_tokens(empty).count() == bpe.decode_tokens(enc.limit(0)).count() == 0

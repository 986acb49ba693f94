"""The corpus pipeline against its stages' brute force, on the small tables and on edge cases."""

from collections import Counter

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from quillspark.llm import bpe, decontam, quality  # noqa: E402
from tests.llm.test_dedup import brute_jaccard, brute_lines, groups_of  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages_are_as_listed():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "byte_bpe"]


def test_run_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scored = {r["doc_id"]: r["keep"] for r in quality.score(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if scored[r["doc_id"]]]
    lines = brute_lines(rows)
    rows = [(d, lines[d, t][0]) if t else (d, t) for d, t in rows if not t or lines[d, t][1] == 0 or lines[d, t][2] < lines[d, t][1]]
    gone = {x for x, r in groups_of(brute_jaccard(rows)).items() if x != r}
    rows = [(d, t) for d, t in rows if d not in gone]
    hit = {r["doc_id"] for r in decontam.decontaminate(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    codec = bpe.Codec(open(bpe.VOCABULARY, "rb").read())
    want = {d: codec.count(t) for d, t in rows if d not in hit}
    got = {r["doc_id"]: r["n_tokens"] for r in corpus_pipeline.run(spark, SF).collect()}
    assert len(want) > 20 and len(got) < docs.count()
    assert got == want


def test_stages_take_anything(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, gone string, named int"
    rows = [(1, "a long enough line of text here\nanother long enough line of text", "en", "s", 1, "g", 1), (1, "a long enough line of text here\nanother long enough line of text", "en", "s", 1, "g", 1), (None, None, None, None, None, None, None), (2, "", "en", "s", 0, "g", 1), (None, "text without an id", "en", "s", 1, "g", 1), (3, "\n", "en", "s", 1, "g", 1)]
    docs = spark.createDataFrame(rows, schema)
    clashing = docs.selectExpr("doc_id", "text", "'a' as n_lines", "'b' as n_deleted", "'c' as run_reach", "'d' as __hit", "'e' as __gone", "'f' as th", "'g' as row")
    for name, stage in corpus_pipeline.STAGES[:-1]:  # no n_chars, and names that operators use
        out = stage(spark, clashing, SF)
        assert out.columns == clashing.columns
        assert all(tuple(r)[2:] == tuple("abcdefg") for r in out.collect())
    for name, stage in corpus_pipeline.STAGES:
        for table in (docs, docs.limit(0)):
            out = stage(spark, table, SF)
            n = out.count()
            assert n <= table.count()
            if name != "byte_bpe":
                assert out.columns == docs.columns
                assert n == 0 or Counter(r["doc_id"] for r in out.collect())[None] == 2


def test_contaminated_documents_go_either_way(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = []
    for most in (corpus_pipeline.MOST_SENT, 0):  # identifiers are sent, or joined by a shuffle
        monkeypatch.setattr(corpus_pipeline, "MOST_SENT", most)
        kept.append(sorted(r["doc_id"] for r in corpus_pipeline.decontaminate(spark, docs, SF).select("doc_id").collect()))
    hit = {r["doc_id"] for r in decontam.decontaminate(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert kept[0] == kept[1] == sorted(r["doc_id"] for r in docs.select("doc_id").collect() if r["doc_id"] not in hit) and hit

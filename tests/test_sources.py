"""Readers, writers, connectors with fixtures, models by stand-ins, the stream, and the queries against their SQL."""

import json
import os
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark import catalog, models
from quillspark.operators import chunking as K
from quillspark.sources import articles, files, pdf, pubmed, sinks
from quillspark.storage import with_row_number

JATS = """<article xmlns:x="u"><front><article-id pub-id-type="pmc">123</article-id><article-id pub-id-type="pmid">9</article-id><article-title>A <i>title</i></article-title>
<journal-title>J</journal-title><pub-date><year>2020</year></pub-date><abstract><p>{long} one</p><sec><p>{long} lost</p></sec></abstract></front>
<body><sec><title>Methods</title><p>{long} two [1, 2]</p><p>short</p><sec><title>Design</title><p>{long} three</p></sec></sec><sec><title>Funding</title><p>{long} four</p></sec></body></article>""".replace("{long}", "word " * 20)


def test_articles(spark, tmp_path):
    (tmp_path / "PMC1.xml").write_text(JATS)
    (tmp_path / "PMC2.xml").write_text("<broken")
    (tmp_path / "PMC3.xml").write_text(f"<article><body><p>{'a ' * 60}</p><sec><p>{'b ' * 60}</p></sec></body></article>")
    got = articles.read_articles(spark, str(tmp_path)).collect()
    rows = [(r["section"], r["paragraph_index"], r["text"][-5:]) for r in got if r["pmcid"] == "123"]
    assert rows == [("Abstract", 1, "d one"), ("Methods", 1, "d two"), ("Methods > Design", 1, "three")]
    first = next(r for r in got if r["pmcid"] == "123")
    assert (first["title"], first["year"], first["journal"], first["pmid"]) == ("A title", "2020", "J", "9")
    assert [r["section"] for r in got if r["pmcid"] == "PMC3"] == ["Body"]
    manifest = {Path(r["source_path"]).name: r["status"] for r in articles.article_manifest(articles.read_articles(spark, str(tmp_path))).collect()}
    assert manifest == {"PMC1.xml": "parsed", "PMC2.xml": "failed", "PMC3.xml": "parsed"}


def test_stream(spark, tmp_path):
    from quillspark.streaming import ingest, new_articles

    src = tmp_path / "in"
    src.mkdir()
    counts = []
    for name in ("PMC1.xml", "PMC2.xml"):
        (src / name).write_text(JATS)
        ingest(new_articles(spark, str(src)), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
        counts.append(spark.read.parquet(str(tmp_path / "out")).count())
    assert counts == [3, 6]


def test_files(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"k": 1, "t": "é"}\n\n{"k": 2}\n')
    assert files.read_jsonl(spark, str(tmp_path / "a.jsonl"), "k int, t string").count() == 2
    assert files.read_jsonl(spark, str(tmp_path / "none"), "k int", optional=True).count() == 0
    (tmp_path / "b.jsonl").write_text("{bad\n")
    with pytest.raises(Exception):
        files.read_jsonl(spark, str(tmp_path / "b.jsonl"), "k int").collect()
    (tmp_path / "pubmed_one.csv").write_text('﻿pmid,pmcid,title\n 1 ,77,"two\nlines"\n', encoding="utf-8")
    (tmp_path / "core.csv").write_text("pmid\n3\n")
    assert [n for n, _ in files.discover_sources(str(tmp_path))] == ["one"]
    row = files.read_sources(spark, files.discover_sources(str(tmp_path))).first()
    assert (row["pmid"], row["pmcid"], row["title"], row["source_name"]) == ("1", "PMC77", "two\nlines", "one")
    os.remove(tmp_path / "pubmed_one.csv")
    assert [n for n, _ in files.discover_sources(str(tmp_path))] == ["core"]
    (tmp_path / "m.jsonl").write_text('{"row_index": 0}\n{"row_index": 2}\n')
    with pytest.raises(ValueError):
        files.read_metadata(spark, str(tmp_path / "m.jsonl"), "row_index int")
    (tmp_path / "q.yaml").write_text("queries:\n  a: {pubmed: ' x   y '}\n  b: {terms: [z]}\n")
    assert files.pubmed_queries(str(tmp_path / "q.yaml")) == {"a": "x y"} and set(files.pubmed_queries()) == {"core_english", "treatment_outcome", "ultrasound", "therapies"}
    (tmp_path / "x_answer.json").write_text('{"answer": "yes"}')
    assert files.read_answer(str(tmp_path / "x_answer.json")) == "yes" and files.sibling("d/x_answer.json", "evidence.json") == "d/x_evidence.json"


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("strict", "a\nb", ["x", "y"]), ("review", None, [])], "bucket string, t string, l array<string>")
    sinks.write_csv(df, str(tmp_path / "c"), ["t", "l", "missing"])
    got = {tuple(r) for r in spark.read.option("header", True).csv(str(tmp_path / "c")).na.fill("").collect()}
    assert got == {("a b", "x; y", ""), ("", "", "")}
    sinks.write_buckets(df, str(tmp_path / "b"))
    assert spark.read.parquet(str(tmp_path / "b")).where("bucket = 'strict'").count() == 1
    sinks.write_jsonl(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    assert "strict: 1" in sinks.bucket_report(df, "R")
    sinks.write_row(df.limit(1), str(tmp_path / "r.json"))
    assert "created_at" in json.loads((tmp_path / "r.json").read_text())


PUBMED = """<S><PubmedArticle><MedlineCitation><PMID>5</PMID><Article><Journal><Title>J</Title><JournalIssue><PubDate><Year></Year></PubDate></JournalIssue></Journal><ArticleTitle>T <b>x</b></ArticleTitle>
<Abstract><AbstractText Label="AIM">one</AbstractText><AbstractText>two</AbstractText></Abstract><ArticleDate><Year>2019</Year></ArticleDate></Article></MedlineCitation>
<PubmedData><ArticleIdList><ArticleId IdType="pmc">PMC8</ArticleId><ArticleId IdType="doi">10.1/z</ArticleId></ArticleIdList></PubmedData></PubmedArticle></S>"""


def test_pubmed(spark, tmp_path):
    (tmp_path / "esearch_my_query.xml").write_text("<r><IdList><Id>5</Id></IdList></r>")
    (tmp_path / "efetch_5.xml").write_text(PUBMED)
    r = pubmed.search(spark, {"k": "my query"}, folder=str(tmp_path)).first()
    assert (r["query_key"], r["pmid"], r["pmcid"], r["year"], r["title"], r["abstract"], r["has_full_text"]) == ("k", "5", "PMC8", "2019", "T x", "AIM: one\ntwo", "yes")


def test_fetch_articles(spark):
    def transport(url):
        if "id=3" in url:
            raise OSError("gone")
        return b"<article/>" if "id=1" in url else b"<html>"

    registry = spark.createDataFrame([("1",), ("2",), ("3",), ("4",), ("",)], "pmcid string")
    have = spark.createDataFrame([("PMC4", 10)], "pmcid string, bytes int")
    got = {r["pmcid"]: r["status"] for r in pubmed.fetch_articles(registry, have, transport).collect()}
    assert got == {"PMC1": "downloaded", "PMC2": "failed", "PMC3": "failed", "PMC4": "skipped_existing"}


def test_pdf(spark):
    class Fake:
        def native(self, content):
            if content == b"bad":
                raise RuntimeError("no")
            return "字" * 80 + "\f" + "x", 2

        def recognise(self, content, page):
            return f"seen {page}"

    pages = pdf.read_pages(spark.createDataFrame([("d/a.pdf", bytearray(b"ok")), ("d/b.pdf", bytearray(b"bad"))], "path string, content binary"), Fake())
    got = {(r["title"], r["page_number"]): (r["extraction_method"], r["text"], r["error"]) for r in pages.collect()}
    assert got["a", 1] == ("native_text", "字" * 80, None) and got["a", 2] == ("ocr", "seen 2", None) and "no" in got["b", None][2]
    assert pages.where("title = 'a'").first()["document_id"] == pdf.document_id("d/a.pdf")


def test_models(spark):
    chunks = spark.createDataFrame([("t", "s", "some text"), (None, None, None)], "title string, section string, text string")
    vectors = [np.array(r["embedding"]) for r in models.embed(chunks).collect()]
    assert all(abs(np.linalg.norm(v) - 1) < 1e-5 for v in vectors)

    class Echo:
        def generate(self, m):
            if "boom" in m[1]["content"]:
                raise RuntimeError("x")
            return m[1]["content"].upper()

    got = {r["query_id"]: (r["answer"], r["error"]) for r in models.generate(spark.createDataFrame([("a", "hi"), ("b", "boom")], "query_id string, prompt string"), Echo).collect()}
    assert got["a"] == ("HI", None) and got["b"][1] == "RuntimeError: x"
    with pytest.raises(ValueError):
        models.generation_settings({})
    assert models.generation_settings({"llm": {"local_model_path": "p"}})["generation"]["max_new_tokens"] == 768


def test_section_pipeline(spark):
    said = [(f"Sentence number {k} says something here.", 1 + k // 4) for k in range(9)]
    df = spark.createDataFrame([("PMC1", "Results", said), ("PMC2", "Body", said[:1])], "pmcid string, section string, sentences array<struct<text:string,paragraph_index:int>>")
    cut = models.semantic_cuts(df, limits=K.Limits(max_sentences=4))
    got = {r["chunk_id"]: r for r in K.section_chunks(cut, K.Limits(max_sentences=4, least=1, most=1000)).collect()}
    assert "PMC1::Results::001" in got and "PMC2::Body::001" in got
    assert sum(r["sentence_count"] for k, r in got.items() if k.startswith("PMC1")) == 9
    zh = spark.createDataFrame([("d", "结果", [("治疗有效。", 1, "ocr"), ("随访。", 2, None)], [1], [0.5])], "document_id string, section string, sentences array<struct<text:string,page_number:int,extraction_method:string>>, cuts array<int>, scores array<double>")
    r = K.section_chunks_cjk(zh).first()
    assert r["source_pages"] == [1, 2] and r["text"] == "治疗有效。 随访。" and r["chunk_id"].startswith("d::SEC-")


def test_row_numbers(spark):
    df = spark.range(0, 1000, 1, 7).select(((F.col("id") * 7919) % 1000).alias("k"))
    assert [(r["k"], r["row_index"]) for r in with_row_number(df, ["k"]).orderBy("k").collect()] == [(k, k) for k in range(1000)]
    assert with_row_number(df.limit(0), ["k"]).count() == 0


def test_queries_agree_with_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    at = "/root/testdata/sf0.001"
    if not os.path.isdir(at):
        pytest.skip("no test tables")
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "conversations", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{at}/{t}.parquet')")

    def plain(v):
        if hasattr(v, "asDict"):
            v = v.asDict()
        if isinstance(v, dict):
            return tuple((k, plain(x)) for k, x in sorted(v.items()))
        if isinstance(v, (list, tuple, np.ndarray)):
            return tuple(plain(x) for x in v)
        return round(v, 6) if isinstance(v, float) else v

    sql = catalog.oracle_sql()
    for name, f in catalog.queries().items():
        df = f(spark, at)
        got = sorted((tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect()), key=repr)
        if name not in sql:
            assert got
            continue
        cur = con.execute(sql[name])
        names = [c[0] for c in cur.description]
        assert sorted(names) == sorted(df.columns), name
        order = sorted(range(len(names)), key=names.__getitem__)
        assert got == sorted((tuple(plain(r[k]) for k in order) for r in cur.fetchall()), key=repr), name


def test_html_sections(spark):
    html = (
        "<html><head><style>p{}</style></head><body>Loose text before any heading.<h1>Main</h1><p>Long enough paragraph one.</p><script>var x = 'not this text at all';</script>"
        "<h2>Part</h2><p>short</p><p>Another <b>long</b> enough &amp; good\n paragraph.</p><h2>References</h2><p>A reference that is long enough.</p><h1>Next</h1><p>Paragraph of the next part.</p></body>"
    )
    pages = spark.createDataFrame([(1, html), (2, None), (3, ""), (4, "<p>never closed but long enough")], "page_id bigint, html string")
    got = sorted((r["page_id"], r["section"], r["paragraph_index"], r["text"], r["char_count"]) for r in articles.html_sections(pages, "page_id", "html", 20).collect())
    want = [(1, "Body", "Loose text before any heading."), (1, "Main", "Long enough paragraph one."), (1, "Main > Part", "Another long enough & good paragraph."), (1, "Next", "Paragraph of the next part."), (4, "Body", "never closed but long enough")]
    assert got == [(k, s, 1, t, len(t)) for k, s, t in want]

"""What the review of round 2 found, on small tables."""

import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillspark import catalog
from quillspark.functions import sentences as SE
from quillspark.functions import text as T
from quillspark.operators import assess
from quillspark.operators import chunking as K
from quillspark.operators import pages as P
from quillspark.operators import semantic as S
from quillspark.sources import articles


def against_sql(spark, name, at):
    """The rows of a query and of its SQL over the tables in a folder, sorted."""
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in (f for f in os.listdir(at) if f.endswith(".parquet")):
        con.execute(f"CREATE VIEW {t[:-8]} AS SELECT * FROM read_parquet('{at}/{t}/*.parquet')")
    df = catalog.queries()[name](spark, str(at))
    cur = con.execute(catalog.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr), sorted(cur.fetchall(), key=repr)


def test_f1_abbreviations_end_sentences_of_q51(spark, tmp_path):
    said = [(8, 0, "Smith et al. La ñaras. See Fig. 2 now."), (8, 1, "Dr. Who? Yes!"), (9, 0, "  "), (9, 1, "No. 5")]
    spark.createDataFrame([(c, t, "user", x) for c, t, x in said], "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got, want = against_sql(spark, "q51_paragraph_sentences", tmp_path)
    assert got == want and (8, 1, "Smith et al.", 0) in got


def test_f2_f3_f4_products_with_many_anchors_are_made_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(S, "ROWS_AT_ONCE", 32)
    monkeypatch.setattr(S, "ANCHORS_AT_ONCE", 16)
    random, most = np.random.default_rng(5), []
    vectors, anchors = random.normal(size=(100, 8)).astype(np.float32), random.normal(size=(70, 8)).astype(np.float32)
    found = S._best_products(vectors.astype(np.float64), anchors.astype(np.float64), np.full((100, 3), -np.inf))
    want = np.sort(vectors.astype(np.float64) @ anchors.astype(np.float64).T, axis=1)[:, -3:]
    assert np.allclose(np.sort(found, axis=1), want)
    monkeypatch.setattr(S, "_best_products", lambda v, a, best, f=S._best_products: most.append((len(v), len(a))) or f(v, a, best))
    texts = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "id int, embedding array<float>")
    held = spark.createDataFrame([(v.tolist(),) for v in anchors], "embedding array<float>")
    for sent in (100, 30, 7):  # sent whole and in parts
        got = {r["id"]: r["score"] for r in S.top_mean_similarity(texts, held, 3, most_sent=sent).collect()}
        assert np.allclose([got[k] for k in range(100)], want.mean(axis=1))
    S._best_with(type("Sent", (), {"value": anchors.astype(np.float64)}), 3).func(pa.array(vectors.tolist()), pa.array([[]] * 100, pa.list_(pa.float64())))
    assert max(most)[0] <= 32


def _records_and_chunks(spark):
    records = spark.createDataFrame([(f"r{k}", k, f"P{k % 3}", f"{k % 2}", "", "strict", "T", "a cow") for k in range(6)] + [("r6", 6, "none", "", "", "strict", "T", "only an abstract")], "record_id string, seq int, pmcid string, pmid string, doi string, status string, title string, abstract string")
    chunks = spark.createDataFrame([(1, "c1", "P0", "1", "x cow"), (2, "c1", "P1", "0", "again"), (3, "c2", "P2", "1", "y"), (4, " ", "P0", "0", "z"), (5, "c3", "", "1", "w"), (6, "c4", "P9", "9", "nobody's")], "seq int, chunk_id string, pmcid string, pmid string, text string")
    return records, chunks


def test_f5_pairs_of_an_identifier_join_are_not_shuffled(spark):
    records, chunks = _records_and_chunks(spark)
    want = {}
    for r in records.collect():
        for c in chunks.collect():
            for prio, field in enumerate(("pmcid", "pmid")):
                if r[field] and r[field] == c[field]:
                    key = (r["record_id"], c["chunk_id"].strip() or f"row:{c['seq']}")
                    want[key] = min(want.get(key, (9, 9)), (prio, c["seq"]))
    want["r6", "pmcid:none::registry_abstract"] = (0, 0)
    for keep in ((), S.KEPT):
        got = S.chunks_of_records(records, chunks, keep=keep)
        assert {(r["record_id"], r["chunk_id"]): (r["place"]["prio"], r["place"]["seq"]) for r in got.collect()} == want and got.count() == len(want)
    # A row for every pair of 600 records and 600 chunks: what is shuffled are their identifiers.
    many = spark.range(600).select(F.concat(F.lit("r"), "id").alias("record_id"), F.lit("P").alias("pmcid"), F.lit("").alias("abstract"), F.lit("").alias("title"))
    parts = spark.range(600).select(F.concat(F.lit("c"), "id").alias("chunk_id"), F.col("id").alias("seq"), F.lit("P").alias("pmcid"))
    linked = S.chunks_of_records(many, parts, keep=())
    plan = linked._jdf.queryExecution().optimizedPlan().toString()
    assert linked.count() == 360_000
    above_pairs = plan.split("Join Inner")[0]  # down to the branch of chunks with keys of their own, nothing gathers its pairs
    assert "Aggregate" not in above_pairs and "Window" not in above_pairs


def test_f6_a_text_is_scored_once_for_all_its_records(spark):
    records, chunks = _records_and_chunks(spark)
    seen = spark.sparkContext.accumulator(0)

    @F.udf("array<double>")
    def encode(text):
        seen.add(1)
        return [float("cow" in text), 1.0]

    anchors = spark.createDataFrame([("animal", "a cow")] * 3 + [("human", "a patient")] * 3, "label string, text string")
    big = records.where("record_id <> 'r6'").crossJoin(spark.range(50)).withColumn("record_id", F.concat("record_id", F.lit("-"), "id")).drop("id")
    rows = assess.assess_records(big, chunks, anchors, encode).select("record_id", "chunk_count", "lexical_hits").collect()
    want = {}
    for r in S.chunks_of_records(records, chunks).collect():
        n, hits = want.get(r["record_id"], (0, 0))
        want[r["record_id"]] = (n + 1, hits + ("cow" in r["text"]))
    assert len(rows) == 300 and all((r["chunk_count"], r["lexical_hits"]) == want[r["record_id"].split("-")[0]] for r in rows)
    assert seen.value < 100  # some anchors and chunks several times, not 300 records' chunks


def _times(df, what):
    return df._jdf.queryExecution().optimizedPlan().toString().count(what)


def test_f7_f9_texts_are_joined_and_cut_once(spark):
    at = "/root/testdata/sf0.001"
    assert _times(catalog.queries()["q44_zh_join_lines"](spark, at), "array_join(") == 1
    assert _times(catalog.queries()["q46_zh_chunk_ranges"](spark, at), "(.+?(?:") == 1  # where sentences are cut


def test_f9_bounds_of_ranges_agree_with_joined_texts(spark):
    random = np.random.default_rng(2)
    words = ["a-", "b", "中", "文字", "c d", "e-f", "g-h-", "-", "", " i", "中 ", "j　k"]
    rows = [([words[k] for k in random.integers(0, len(words), random.integers(1, 9))],) for _ in range(300)]
    df = spark.createDataFrame(rows, "t array<string>").select("t", F.transform("t", T.unit_count).alias("u"), F.transform("t", lambda x: F.length(x)).alias("l"))
    x = K._measured(F.struct(F.lit(0).alias("start"), F.size("t").alias("stop")), F.col("u"), F.col("l"))
    for r in df.select(x.alias("x"), T.unit_count(SE.join_lines_cjk("t")).alias("n"), F.length(SE.join_lines_cjk("t")).alias("c")).collect():
        assert r["x"]["n"] - r["x"]["m"] <= r["n"] <= r["x"]["n"] and r["c"] <= r["x"]["c"]


def test_f8_pages_are_neither_shuffled_nor_read_for_margins_again(spark):
    pages = spark.createDataFrame([("d", k, f"Head {k}\n- {k} -\ntext of page {k}。\nFoot") for k in range(5)] + [("e", 1, "Head 1\n12")], "document_id string, page_number int, text string")
    done = P.without_margins(pages)
    assert {(r["document_id"], r["page_number"]): r["text"] for r in done.collect()} == {**{("d", k): f"text of page {k}。" for k in range(5)}, ("e", 1): "Head 1\n12"}
    plan = done._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in plan.split("BroadcastHashJoin")[0] and "rightHint=(strategy=broadcast)" in done._jdf.queryExecution().optimizedPlan().toString()
    found = P.repeated_margins(pages)
    assert "size(" not in [x for x in found._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Filter" in x and "regexp" in x].__str__()


def test_f10_a_heading_is_looked_for_once(spark):
    lines = spark.createDataFrame([("一、结果",), ("【摘要】",), ("3.1.2、一般资料",), ("x",)], "line string").select(P.heading("line").alias("h"))
    assert [r["h"] for r in lines.collect()] == ["结果", "摘要", "临床资料", None]
    assert _times(lines, "regexp_replace(") < 60  # several hundred where each name's test had the whole line cleaned again


def test_f11_sentences_are_cut_a_few_rows_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(SE, "ROWS_AT_ONCE", 2)
    rows = [["x" * 3700], None, ["short", "y" * 1801], [], ["z"]]
    want = [["x" * 1800, "x" * 1800, "x" * 100], None, ["short", "y" * 1800, "y"], [], ["z"]]
    parts = list(SE._cut(pa.array(rows, pa.list_(pa.string()))))
    assert [len(p) for p in parts] == [2, 2, 1] and pa.concat_arrays(parts).to_pylist() == want
    df = spark.createDataFrame([(k, r) for k, r in enumerate(rows)], "k int, s array<string>").coalesce(1)
    assert [r["s"] for r in df.select("k", SE.within_limits("s").alias("s")).orderBy("k").collect()] == want
    assert [r["s"] for r in SE.with_limits(df, "s").orderBy("k").collect()] == want


def test_f12_paragraphs_are_passed_on_before_all_files_are_parsed(spark):
    body = "<article><body><sec><title>S</title><p>{}</p></sec></body></article>".format("word " * 30)
    files = spark.range(0, 500, 1, 1).select(F.concat(F.lit("/x/"), "id").alias("path"), F.encode(F.when(F.col("id") % 5 == 0, "<article>").otherwise(body), "UTF-8").alias("content"))
    found = articles.parse_articles(files, 40)
    assert {r["status"]: r["count"] for r in found.groupBy("status").count().collect()} == {"parsed": 400, "failed": 100}
    sizes = found.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n long")
    assert max(r["n"] for r in sizes.collect()) <= 500 and articles.FILES_AT_ONCE < 500

"""The second pass as a whole, evidence packages, judging, failure capture, and small operators over inputs."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark import models
from quillspark.__main__ import main
from quillspark.operators import assess, chunking, pages, retrieval, semantic
from quillspark.sources import files, sinks


class Toy:
    """Two directions: animals and humans."""

    def encode(self, texts):
        return np.array([[1.0, 0.0] if "cow" in t.lower() or "udder" in t.lower() else [0.6, 0.8] if "mixed" in t.lower() else [0.0, 1.0] for t in texts], np.float32)


RECORDS = [
    ("a", 0, "strict", "p1", "", "Bovine mastitis in dairy cows", ""), ("b", 1, "strict", "p2", "", "Patients with mastitis", ""),
    ("c", 2, "review", "p3", "", "No chunk but an abstract", "The cows had udder pain in this cattle herd."), ("d", 3, "strict", "p4", "10.1/X", "Nothing at all", ""),
]
CHUNKS = [
    ("1", 0, "p1", "", "The cow had mastitis of the udder."), ("2", 1, "p1", "", "Bovine udder again, a cow."), ("3", 2, "p2", "", "A patient was treated."), ("4", 3, "p2", "", "Women recovered."), ("5", 4, "p9", "", "A cow of nobody's."),
]


def tables(spark):
    records = spark.createDataFrame(RECORDS, "record_id string, seq int, status string, pmid string, doi string, title string, abstract string")
    chunks = spark.createDataFrame([(*c, "strict") for c in CHUNKS], "chunk_id string, seq int, pmid string, doi string, text string, bucket string").withColumns({"title": F.lit("t"), "section": F.lit("s"), "source_type": F.lit("pmc_full_text")})
    anchors = spark.createDataFrame([("animal", "a cow")] * 3 + [("human", "a patient")] * 3, "label string, text string")
    return records, chunks, anchors


def test_second_pass(spark):
    records, chunks, anchors = tables(spark)
    done = assess.assess_records(records, chunks, anchors, models.encoder_udf(Toy))
    got = {r["record_id"]: r for r in done.collect()}
    assert {k: (r["semantic_decision"], r["semantic_final_status"]) for k, r in got.items()} == {
        "a": ("exclude_animal", "excluded"), "b": ("keep", "strict"), "c": ("exclude_animal", "excluded"), "d": ("not_assessed", "strict"),
    }
    assert got["a"]["chunk_count"] == 2 and got["a"]["animal_hits"] == 2 and got["a"]["max_animal_score"] == pytest.approx(1.0) and got["c"]["chunk_count"] == 1
    whole = assess.annotate(done, records.limit(1).withColumn("record_id", F.lit("old")).drop("status"))
    old = {r["record_id"]: r for r in whole.collect()}["old"]
    assert (old["semantic_decision"], old["semantic_final_status"], old["chunk_count"]) == ("not_checked_existing_exclude", "excluded", 0) and whole.count() == 5
    routed = {r["chunk_id"]: (r["final_bucket"], r["semantic_decision"]) for r in assess.route(chunks, done, ["chunk_id"]).collect()}
    assert routed == {"1": ("excluded", "exclude_animal"), "2": ("excluded", "exclude_animal"), "3": ("strict", "keep"), "4": ("strict", "keep"), "5": ("strict", "not_matched_to_registry")}
    with pytest.raises(ValueError):
        assess.assess_records(records, chunks, anchors.where("label = 'human'"), models.encoder_udf(Toy))
    none = assess.assess_records(records, chunks.limit(0), anchors, models.encoder_udf(Toy))
    assert {r["record_id"]: r["semantic_decision"] for r in none.collect()} == {"a": "not_assessed", "b": "not_assessed", "c": "exclude_animal", "d": "not_assessed"}


def test_inputs(spark):
    names = spark.createDataFrame([(f"/x/{n}",) for n in ("b.pdf", "A.pdf", "C.pdf", "a.pdf")], "path string")
    assert [r["path"][3:] for r in assess.by_name(names).collect()] == ["A.pdf", "a.pdf", "b.pdf", "C.pdf"]
    assert assess.selected(names, "A.P", "path").count() == 2 and assess.selected(names, None, "path").count() == 4
    assert [r["path"] for r in assess.first_rows(names, 1, ["path"]).collect()] == ["/x/A.pdf"] and assess.first_rows(names, None, ["path"]).count() == 4
    with pytest.raises(ValueError):
        assess.first_rows(names, 0, ["path"])
    both = assess.with_status(strict=names, review=names.limit(1))
    assert {(r["status"], r["count"]) for r in both.groupBy("status").count().collect()} == {("strict", 4), ("review", 1)}
    totals = spark.createDataFrame([("D", "t", "s", 3, 2, 1, 0, "parsed"), ("E", "t", "s", 0, 0, 0, 0, "failed: x")], "document_id string, title string, source_path string, page_count int, native_pages int, ocr_pages int, low_text_pages int, status string")
    [r] = assess.registry_record(totals).collect()
    assert (r["document_id"], r["parse_status"], r["empty_pages"], r["abstract"], r["language"]) == ("D", "parsed", 0, "", "zh")


class Breaks:
    def encode(self, texts):
        if any("broken" in t for t in texts):
            raise RuntimeError("no such word")
        return np.ones((len(texts), 2), np.float32)


def test_a_section_that_fails_is_told_and_others_go_on(spark):
    said = F.array(*(F.struct(F.concat(F.lit(f"Sentence {k} of the "), "section").alias("text"), F.lit(k).alias("paragraph_index")) for k in range(4)))
    sections = spark.createDataFrame([("1", "good"), ("1", "broken"), ("2", "fine")], "pmcid string, section string").withColumn("sentences", said)
    cut = models.semantic_cuts(sections, Breaks)
    chunks = chunking.section_chunks(cut.where("error is null"))
    got = {r["section"]: (r["status"], r["chunks"], r["similarity_gaps"], r["error"]) for r in models.chunk_manifest(cut, chunks).collect()}
    assert got == {"good": ("parsed", 1, 3, ""), "fine": ("parsed", 1, 3, ""), "broken": ("failed", 0, 0, "RuntimeError: no such word")}


class Says:
    def __init__(self, said):
        self.said = said

    def generate(self, messages):
        if "break" in messages[-1]["content"]:
            raise RuntimeError("out of memory")
        return self.said


def test_judge(spark):
    answers = spark.createDataFrame([("q", "question", "An answer"), ("r", "question", "break")], "query_id string, question string, answer string")
    answers = answers.withColumn("evidence", F.array(F.struct(F.lit("E1").alias("evidence_id"), F.lit("c").alias("citation"), F.lit("text " * 400).alias("text"))))
    said = '```json\n{"status": "pass", "faithfulness_score": 5, "groundedness_score": 4, "safety_score": 5, "comments": "good", "unsupported_claims": []}\n```'
    got = {r["query_id"]: r["judgement"] for r in models.judge(answers, lambda: Says(said)).collect()}
    assert (got["q"]["status"], got["q"]["groundedness_score"], got["q"]["parse_error"]) == ("pass", 4, False)
    assert (got["r"]["status"], got["r"]["parse_error"]) == ("warning", True) and "out of memory" in got["r"]["raw_response"]


def test_evidence_package_and_answer(spark, tmp_path):
    rows = [(k, f"c{k}", f"About {w} and its treatment", w) for k, w in enumerate(("mastitis", "abscess", "fever"))]
    chunks = spark.createDataFrame(rows, "row_index int, chunk_id string, title string, text string").withColumn("section", F.lit("Body"))
    index = retrieval.build_index(models.embed(chunks))
    index.write.parquet(str(tmp_path / "index"))
    asked = spark.createDataFrame([("q", "mastitis")], "query_id string, query string")
    found = models.retrieve_evidence(index, asked, top_k=2).orderBy("rank").collect()
    assert [r["evidence_id"] for r in found] == ["E1", "E2"] and found[0]["chunk_id"] == "c0"
    assert main(["answer-package", str(tmp_path / "index"), "What of mastitis?", str(tmp_path / "rag"), "--top-k", "2"]) == 0
    package = json.loads((tmp_path / "rag/What_of_mastitis_evidence.json").read_text())
    assert package["evidence_count"] == 2 and package["question"] == "What of mastitis?" and package["evidence"][0]["evidence_id"] == "E1"
    prompt = tmp_path / "rag/What_of_mastitis_prompt.txt"
    assert "[E1]" in prompt.read_text()
    config = tmp_path / "llm.yaml"
    config.write_text("llm:\n  local_model_path: /nowhere\n")
    import argparse

    from quillspark.__main__ import generate_answer

    a = argparse.Namespace(prompt=str(prompt), config=str(config), out=None)
    assert generate_answer(spark, a, lambda: Says(" Because [E1]. ")) == 0
    written = files.sibling(str(prompt), "answer")
    assert open(f"{written}.md").read() == "Because [E1].\n" and json.loads(open(f"{written}.json").read())["generation"]["max_new_tokens"] == 768
    assert generate_answer(spark, a, lambda: Says(1 / 0) if False else Broken()) == 2
    with pytest.raises(ValueError):
        models.quantization("4bit")
    assert models.quantization("none") is None


class Broken:
    def generate(self, messages):
        raise RuntimeError("no device")


class Tokens(dict):
    pass


def test_model_inputs_take_either_shape():
    class Plain:
        chat_template = None

        def __call__(self, text, return_tensors):
            return Tokens(input_ids=np.array([[len(text)]]), attention_mask=np.array([[1]]))

    class Template:
        chat_template = "x"

        def apply_chat_template(self, messages, add_generation_prompt, return_tensors):
            return np.array([[1, 2, 3]])

    ids, mask = models.model_inputs(Plain(), [{"role": "user", "content": "hello"}])
    assert ids.tolist() == [[len("user: hello")]] and mask.tolist() == [[1]]
    ids, mask = models.model_inputs(Template(), [])
    assert ids.tolist() == [[1, 2, 3]] and mask.tolist() == [[1, 1, 1]]


def test_search_in_blocks_agrees_with_sent_queries(spark):
    rng = np.random.default_rng(2)
    rows = [(k, [float(x) for x in rng.normal(size=5)]) for k in range(300)] + [(300 + k, [1.0, 0.0, 0.0, 0.0, 0.0]) for k in range(12)] + [(400, None), (401, [0.0] * 5)]
    index = retrieval.build_index(spark.createDataFrame(rows, "row_index int, embedding array<float>")).repartition(3)
    asked = index.where("row_index % 10 = 0").withColumnRenamed("row_index", "query_id")
    unit = {r["row_index"]: r["embedding"] for r in index.collect() if r["embedding"] is not None}
    want = {(q, r, n + 1) for q in unit if q % 10 == 0 for n, r in enumerate(sorted(unit, key=lambda r: (-round(float(np.dot(unit[q], unit[r])), 9), r))[:8])}
    for most in (10_000, 3):
        got = retrieval.search(index, asked, most_sent=most).collect()
        assert {(r["query_id"], r["row_index"], r["rank"]) for r in got} == want and len(got) == len(want)
    assert retrieval.search(index, asked.limit(0)).count() == 0


def test_chinese_and_checked_index_commands(spark, tmp_path):
    at = lambda name: str(tmp_path / name)
    text = "摘要\n" + "肉芽肿性小叶性乳腺炎患者经药物治疗后随访，疗效良好。" * 12 + "\n结果\n" + "患者均治愈，无复发，临床疗效满意。" * 12
    page = {"document_id": "CNKI-1", "title": "肉芽肿性乳腺炎的治疗", "journal": "", "year": "", "doi": "", "source_path": "a.pdf", "page_number": 1, "extraction_method": "native_text", "text": text}
    spark.createDataFrame([page]).withColumn("error", F.lit(None).cast("string")).write.parquet(at("pages"))
    spark.createDataFrame([("CNKI-1", "肉芽肿性乳腺炎的治疗", "a.pdf")], "document_id string, title string, source_path string").write.parquet(at("registry"))
    assert main(["chunk-documents", at("pages"), at("chunks")]) == 0
    assert main(["chunk-documents", at("pages"), at("none"), "--select", "zzz"]) == 0
    chunks = spark.read.parquet(at("chunks"))
    assert {r["section"] for r in chunks.collect()} == {"摘要", "结果"}
    assert main(["filter-documents", at("registry"), at("chunks"), at("filtered")]) == 0
    assert {r["bucket"] for r in spark.read.parquet(at("filtered/chunks")).collect()} == {"strict"} and "strict: 2" in open(at("filtered/report.md")).read()
    assert main(["build-checked-index", at("chunks"), at("built"), "--language", "zh"]) == 0
    assert json.loads(open(at("built/index.json")).read())["ready_for_retrieval"]
    (tmp_path / "smoke.yaml").write_text("queries:\n- id: a\n  query: 疗效\n  expected_any: [乳腺炎]\n")
    assert main(["test-index", at("built/index"), at("smoke.yaml"), at("smoke")]) == 0
    (tmp_path / "smoke2.yaml").write_text("queries:\n- id: a\n  query: 疗效\n  expected_any: [没有这个词]\n")
    assert main(["test-index", at("built/index"), at("smoke2.yaml"), at("smoke2")]) == 2


def test_second_pass_command(spark, tmp_path):
    at = lambda name: str(tmp_path / name)
    words = "in this study of the treatment and the diagnosis with many further words here"
    rows = []
    for k in range(4):
        rows.append((f"pmid:h{k}", "strict", f"h{k}", f"Women with mastitis {k}", f"Patients with granulomatous mastitis number {k} were seen {words}."))
        rows.append((f"pmid:a{k}", "excluded", f"a{k}", f"Dairy cows {k}", f"Bovine mastitis of dairy cows number {k} was seen {words}."))
    registry = spark.createDataFrame([(d, b, p, "", t, "") for d, b, p, t, _ in rows], "dedupe_key string, bucket string, pmid string, doi string, title string, abstract string")
    chunks = spark.createDataFrame([(f"c{k}", b, p, "", t, "Body", "pmc_full_text", x) for k, (_, b, p, t, x) in enumerate(rows)], "chunk_id string, bucket string, pmid string, doi string, title string, section string, source_type string, text string")
    sinks.write_buckets(registry, at("filtered/registry"))
    sinks.write_buckets(chunks, at("filtered/chunks"))
    assert main(["second-pass", at("filtered"), at("few")]) == 2  # too few anchors
    assert main(["second-pass", at("filtered"), at("out"), "--least-anchors", "2"]) == 0
    final = spark.read.parquet(at("out/registry"))
    assert final.count() == 8 and final.where("semantic_decision = 'not_checked_existing_exclude'").count() == 4
    assert spark.read.parquet(at("out/chunks")).count() == 8 and "## Decisions" in open(at("out/report.md")).read()


def test_reports(spark):
    assert "total: 3" in sinks.merge_report({"total": 3, "source:a": 2}) and "a: 2" in sinks.merge_report({"total": 3, "source:a": 2})
    vectors = spark.createDataFrame([([1.0, 0.0],)], "embedding array<float>")
    assert sinks.embedding_manifest(vectors, "m", "s")["embedding_dim"] == 2 and sinks.index_manifest(vectors, "p")["chunk_count"] == 1
    totals = spark.createDataFrame([("D", "t", 3, 2, 1, 0, "parsed"), ("E", "u", None, None, None, None, "failed: x")], "document_id string, title string, page_count int, native_pages int, ocr_pages int, low_text_pages int, status string")
    report = sinks.parse_report(totals)
    assert "failed: 1" in report and "E: u" in report and "page_count: 3" in report
    assert pages.REFERENCES and semantic.MOST_SENT

"""Small cases of the corpus operators: classification, merging, chunking, pages, semantics, retrieval, evaluation."""

import json
import re

import pytest
from pyspark.sql import functions as F

from quillspark.functions import sentences as SE
from quillspark.functions import text as T
from quillspark.operators import chunking as K
from quillspark.operators import classify as C
from quillspark.operators import evaluate as E
from quillspark.operators import pages as P
from quillspark.operators import registry as R
from quillspark.operators import retrieval as RE
from quillspark.operators import semantic as S
from quillspark.operators import validate as V


def one(spark, column, schema="x string", value=(None,)):
    return spark.createDataFrame([tuple(value)], schema).select(column.alias("v")).first()["v"]


def decide(spark, title, abstract=""):
    return C.classify_records(spark.createDataFrame([(title, abstract, "")], "title string, abstract string, journal string")).first()["decision"]


@pytest.mark.parametrize(
    "title, abstract, want",
    [
        ("Rifampicin for granulomatous lobular mastitis", "Patients with idiopathic granulomatous mastitis had antibiotic therapy.", "include"),
        ("Bovine mastitis in dairy cows", "Udder health and somatic cell count in a herd.", "exclude"),
        ("Breast cancer imaging", "carcinoma and tumor", "exclude"),
        ("Granulomatous mastitis", "", "review"),
        ("", "", "exclude"),
    ],
)
def test_classify(spark, title, abstract, want):
    assert decide(spark, title, abstract)["decision"] == want


def test_hyphen_is_a_boundary_so_nonlactational_hits_lactational(spark):
    d = decide(spark, "non-lactational mastitis")
    assert "non-lactational mastitis" in d["include_matches"] and "lactational mastitis" in d["exclude_matches"]


def test_plural_only_without_final_s(spark):
    assert "goat" in decide(spark, "goats")["exclude_matches"] and "goats" in decide(spark, "goats")["exclude_matches"]
    assert decide(spark, "cowslip")["exclude_matches"] == []


def test_classify_cjk(spark):
    rows = [("特发性肉芽肿性乳腺炎的药物治疗 患者60例",), ("奶牛乳腺炎的治疗",), ("哺乳期乳腺炎 通乳",), ("无关",), (None,)]
    got = [r["decision"]["decision"] for r in C.classify_records_cjk(spark.createDataFrame(rows, "title string")).collect()]
    assert got == ["include", "exclude", "exclude", "exclude", "exclude"]


def test_article_matrix(spark):
    d = "struct<decision:string,include_score:int,exclude_score:int,include_matches:array<string>,exclude_matches:array<string>,review_reason:string>"
    def dec(x, hits=()):
        return (x, 1, 0, [], list(hits), "")
    rows = [("a", dec("exclude"), dec("include")), ("b", dec("include"), dec("include", ["cow"])), ("c", dec("include"), dec("include")), ("d", dec("include"), dec("exclude")), ("e", None, dec("include")), ("f", dec("review"), dec("review")), ("g", None, dec("exclude"))]
    got = {r["id"]: (r["bucket"], r["filter_level"]) for r in C.route_chunks(spark.createDataFrame(rows, f"id string, article {d}, decision {d}")).collect()}
    assert got == {"a": ("excluded", "article"), "b": ("review", "chunk_noise_review"), "c": ("strict", "article_and_chunk"), "d": ("review", "chunk"), "e": ("review", "chunk_without_included_article"), "f": ("review", "chunk"), "g": ("excluded", "chunk")}
    cjk = spark.createDataFrame(rows, f"id string, article {d}, decision {d}").withColumn("text", F.when(F.col("id") == "d", "奶牛").otherwise("文")).withColumn("section", F.lit(""))
    got = {r["id"]: (r["bucket"], r["filter_level"]) for r in C.route_chunks_cjk(cjk).collect()}
    assert got["d"] == ("review", "chunk_animal_review") and got["c"] == ("strict", "article") and got["e"] == ("review", "missing_registry") and got["f"] == ("review", "article_review")


def test_last_decision_of_an_id_wins_and_first_id_is_asked_first(spark):
    records = spark.createDataFrame([(1, "PMC1", "7", "", "x"), (2, "", "7", "", "y")], "seq int, pmcid string, pmid string, doi string, decision string")
    by = C.decisions_by_id(records, "seq")
    assert {r["id"]: r["decision"] for r in by.collect()} == {"pmc1": "x", "7": "y"}
    chunks = spark.createDataFrame([("k1", "pmc1", "7"), ("k2", "", "7"), ("k3", "", "8")], "chunk_id string, pmcid string, pmid string")
    got = {r["chunk_id"]: r["article"] for r in C.with_article(chunks, by, ["chunk_id"]).collect()}
    assert got == {"k1": "x", "k2": "y", "k3": None}


def test_merge(spark):
    cols = "seq int, source_name string, source_rank int, " + ", ".join(f"{f} string" for f in R.FIELDS)
    def rec(seq, src, rank, **f):
        return (seq, src, rank, *(f.get(c, "") for c in R.FIELDS))
    rows = [rec(1, "drug_therapy", 0, pmid="10", title="A"), rec(2, "rifampin", 1, pmid="10", pmcid="PMC5", title="B"), rec(3, "rifampin", 1, doi="10.1/X"), rec(4, "drug_therapy", 0, doi="10.1/x", year="2020"), rec(5, "rifampin", 1), rec(6, "rifampin", 1)]
    got = {r["dedupe_key"]: r for r in R.merge(spark.createDataFrame(rows, cols)).collect()}
    assert set(got) == {"pmid:10", "doi:10.1/x", "title:"}
    a = got["pmid:10"]
    assert (a["title"], a["pmcid"], a["source_queries"], a["source_query_count"]) == ("A", "PMC5", "drug_therapy;rifampin", "2")
    assert got["doi:10.1/x"]["year"] == "2020" and got["title:"]["first_seq"] == 5
    assert R.merge(spark.createDataFrame([], cols)).count() == 0


def test_combine_keeps_first_and_blank_ids(spark):
    a = spark.createDataFrame([(0, "x", "", "1"), (1, "", "t", "2"), (2, "", "t", "3")], "seq int, chunk_id string, source_type string, text string")
    b = spark.createDataFrame([(0, "x", "t", "4"), (1, "y", "t", "5")], "seq int, chunk_id string, source_type string, text string")
    got = sorted((r["text"], r["source_type"]) for r in R.combine([a, b]).collect())
    assert got == [("1", "pmc_full_text"), ("2", "t"), ("3", "t"), ("5", "t")]


def test_sentences(spark):
    got = one(spark, SE.split_sentences(F.lit("Dr. Smith et al. agreed.  See Fig. 2 here. Is it so? Yes!")))
    assert got == ["Dr. Smith et al. agreed.", "See Fig. 2 here.", "Is it so?", "Yes!"]
    assert one(spark, SE.split_sentences(F.lit(" "))) == []
    assert one(spark, SE.split_sentences_cjk(F.lit("治疗有效率较高。随访一年未见复发！好。完"))) == ["治疗有效率较高。", "随访一年未见复发！", "好。完"]
    assert one(spark, SE.join_lines_cjk(F.array(F.lit("肉芽肿"), F.lit("乳腺炎 the trans-"), F.lit("port of"), F.lit("it")))) == "肉芽肿乳腺炎 the transport of it"
    long = "字" * 2000
    assert max(map(len, SE.cut_long(long))) <= 1800 and "".join(SE.cut_long(long)) == long


def test_boundaries(spark):
    v = F.array(*(F.lit(x) for x in (0.91, 0.88, 0.42, 0.89, 0.86)))
    assert one(spark, K.boundaries(v)) == [3]
    assert one(spark, K.boundaries(F.array().cast("array<double>"))) == []
    assert one(spark, K.boundaries(F.array_repeat(F.lit(0.5), 30))) == [12, 24]
    assert abs(one(spark, K.percentile(v, 20)) - 0.772) < 1e-9


def test_ranges_fold(spark):
    def r(x):
        return [(p["start"], p["stop"]) for p in x]
    cuts = F.array(F.lit(2), F.lit(2), F.lit(4), F.lit(0), F.lit(9))
    assert r(one(spark, K.ranges(F.lit(6), cuts))) == [(0, 2), (2, 4), (4, 6)]
    sizes = F.array(*(F.lit(x) for x in (50, 20, 300, 100, 10, 200)))
    assert r(one(spark, K.merge_short(K.ranges(F.lit(6), cuts), sizes))) == [(0, 2), (2, 4), (4, 6)]
    assert r(one(spark, K.merge_short(K.ranges(F.lit(6), cuts), F.array_repeat(F.lit(10), 6)))) == [(0, 6)]
    assert r(one(spark, K.split_oversized(F.array(F.struct(F.lit(0).alias("start"), F.lit(6).alias("stop"))), sizes))) == [(0, 2), (2, 4), (4, 6)]
    texts = F.array(F.lit("字" * 100), F.lit("字" * 300), F.lit("字" * 20))
    whole = K.merge_short(K.ranges(F.lit(3), F.array(F.lit(1), F.lit(2))), F.array(F.lit(100), F.lit(300), F.lit(20)), K.CJK, texts, backward=True)
    assert r(one(spark, whole)) == [(0, 3)]


def test_abstract_chunks(spark):
    rows = [("1001", "", "T", "One sentence. " * 3), ("", "10.1/a b", "T", " ".join(f"{'w ' * 100}end{i}." for i in range(5))), ("", "", "My Title!", "x"), ("5", "", "", " ")]
    got = K.abstract_chunks(spark.createDataFrame(rows, "pmid string, doi string, title string, abstract string")).collect()
    by = {r["chunk_id"]: r for r in got}
    assert by["PMID1001::Abstract::001"]["source_url"].endswith("/1001/")
    assert [r["word_count"] for k, r in sorted(by.items()) if k.startswith("DOI10.1_a_b::Abstract")] == [202, 202, 101]
    assert "TITLEMy_Title::Abstract::001" in by and len(got) == 5


def test_margins_and_pages(spark):
    rows = [("d", k, f"Journal of X 第{k}页\nbody {"abcde"[k]} text\n{k}", "native_text", False) for k in range(1, 5)] + [("e", 1, "Journal of X\n2", "ocr", True)]
    got = {(r["document_id"], r["page_number"]): r["text"] for r in P.without_margins(spark.createDataFrame(rows, "document_id string, page_number int, text string, extraction_method string, low_text boolean")).collect()}
    assert got["d", 2] == "body c text" and got["e", 1] == "Journal of X\n2"
    assert one(spark, T.split_pages(F.lit("a\fb\f"), F.lit(4))) == ["a", "b", "", ""]
    assert one(spark, T.split_pages(F.lit("a\fb\fc"), F.lit(2))) == ["a", "b\nc"]


@pytest.mark.parametrize("line, want", [("1.3 纳入标准", "纳入与排除标准"), ("摘要", "摘要"), ("二、结果", "结果"), ("30 例患者", None), ("【讨论】", "讨论"), ("治疗患者", None), ("2 方法", "治疗方法"), ("参考文献", "参考文献")])
def test_headings(spark, line, want):
    assert one(spark, P.heading(F.lit(line))) == want


def test_sections(spark):
    rows = [("d", 1, "论文题目", "native_text", "论文题目\n摘要\n目的是研究治疗效果。\n结果"), ("d", 2, "论文题目", "ocr", "有效率为百分之九十。\n参考文献\n[1] 某某某某某某。")]
    got = {r["section"]: [s["text"] for s in r["sentences"]] for r in P.sections(spark.createDataFrame(rows, "document_id string, page_number int, title string, extraction_method string, text string")).collect()}
    assert got == {"正文": ["论文题目"], "摘要": ["目的是研究治疗效果。"], "结果": ["有效率为百分之九十。"]}
    assert P.sections(spark.createDataFrame([], "document_id string, page_number int, title string, extraction_method string, text string")).count() == 0


def test_decide_articles(spark):
    cols = "id string, chunk_count bigint, animal_hits bigint, animal_ratio double, lexical_hits bigint, max_animal_score double, title_animal_terms array<string>, title_human_terms array<string>, status string"
    rows = [("over", 10, 6, 0.6, 6, 0.7, [], [], "strict"), ("equal", 10, 4, 0.4, 4, 0.7, [], [], "strict"), ("single", 1, 1, 1.0, 1, 0.7, [], [], "strict"), ("title", 10, 1, 0.1, 0, 0.7, ["cow"], [], "review"), ("safe", 10, 6, 0.6, 6, 0.7, [], ["women"], "strict"), ("few", 10, 1, 0.1, 1, 0.7, [], [], "strict"), ("none", 0, 0, None, 0, None, [], [], "review")]
    got = {r["id"]: (r["semantic_decision"], r["semantic_final_status"]) for r in S.decide_articles(spark.createDataFrame(rows, cols)).collect()}
    assert got == {"over": ("exclude_animal", "excluded"), "equal": ("review_animal", "review"), "single": ("exclude_animal", "excluded"), "title": ("exclude_animal", "excluded"), "safe": ("keep", "strict"), "few": ("keep", "strict"), "none": ("not_assessed", "review")}


def test_anchors_and_top_mean(spark):
    text = "In this herd bovine mastitis of dairy cows was studied over two long years in many different places. Short one."
    chunks = spark.createDataFrame([(1, "c1", "PMC1", "t", text), (2, "c2", "PMC1", "t", text)], "seq int, chunk_id string, pmcid string, title string, text string")
    got = S.anchors(chunks, "animal").collect()
    assert len(got) == 1 and got[0]["source_id"] == "pmcid:PMC1" and got[0]["chunk_id"] == "c1"
    vec = spark.createDataFrame([(1, [1.0, 0.0])], "id int, embedding array<float>")
    anchors = spark.createDataFrame([([1.0, 0.0],), ([0.8, 0.6],), ([0.0, 1.0],)], "embedding array<float>")
    assert abs(S.top_mean_similarity(vec, anchors, 2).first()["score"] - 0.9) < 1e-6
    assert abs(S.top_mean_similarity(vec, anchors, 2, most_sent=1).first()["score"] - 0.9) < 1e-6
    with pytest.raises(ValueError):
        S.Thresholds(ratio=0.1, review_ratio=0.2)


def test_search(spark):
    index = RE.build_index(spark.createDataFrame([(0, [1.0, 0.0, 0.0]), (1, [0.0, 2.0, 0.0]), (2, [0.0, 0.0, 0.0])], "row_index int, embedding array<float>"))
    queries = spark.createDataFrame([("q", [0.1, 1.0, 0.0])], "query_id string, embedding array<float>")
    assert [(r["row_index"], r["rank"]) for r in RE.search(index, queries, 2).orderBy("rank").collect()] == [(1, 1), (0, 2)]
    assert RE.search(index, queries, 99).count() == 3
    found = RE.evidence(RE.search(index, queries, 2).withColumns({"year": F.lit("2020"), "title": F.lit("T"), "text": F.lit("body")}))
    rows = sorted(found.collect(), key=lambda r: r["rank"])
    assert [r["evidence_id"] for r in rows] == ["E1", "E2"] and rows[0]["citation"] == "2020 | T"
    asked = spark.createDataFrame([("q", "why?"), ("r", "none?")], "query_id string, question string")
    got = {r["query_id"]: r for r in RE.prompts(asked, found).collect()}
    assert "[E1] 2020 | T" in got["q"]["prompt"] and "No evidence retrieved." in got["r"]["prompt"] and got["q"]["evidence_count"] == 2


def test_rules_and_judge(spark):
    rows = [("good " * 30 + "[E1] [E2] [E1]",), ("bad <think> [E9] 可以换药",), ("word " * 30 + "[E1]",), (None,)]
    df = spark.createDataFrame(rows, "answer string").withColumn("known_evidence_ids", F.array(F.lit("E10"), F.lit("E2"), F.lit("E1")))
    got = E.evaluate_rules(df).collect()
    assert [r["status"] for r in got] == ["pass", "fail", "warning", "fail"]
    assert got[0]["citations"] == ["E1", "E2"] and got[0]["known_evidence_ids"] == ["E1", "E2", "E10"]
    assert {i["code"] for i in got[1]["issues"]} == {"short_answer", "think_leak", "low_citation_count", "unknown_citation", "clinical_advice"}
    j = one(spark, E.parse_judgement(F.lit('x\n```json\n{"status": "pass", "safety_score": 4}\n```')))
    assert (j["status"], j["safety_score"], j["faithfulness_score"], j["parse_error"]) == ("pass", 4, 0, False)
    assert one(spark, E.parse_judgement(F.lit("no")))["parse_error"] and one(spark, E.parse_judgement(F.lit("{broken}")))["status"] == "warning"
    assert [one(spark, E.should_judge(F.lit(s), m, w)) for s, m, w in (("pass", "judge", False), ("fail", "rules", True), ("fail", "all", True), ("pass", "all", True), ("pass", "all", False))] == [True, False, True, False, True]
    assert one(spark, E.overall(F.lit("pass"), F.lit("skipped"))) == "pass" and one(spark, E.overall(F.lit("pass"), F.lit("odd"))) == "warning"


def test_validation(spark):
    schema = "row_index int, chunk_id string, title string, language string, source_type string, source_path string, text string, document_id string, source_pages array<int>, page_start int, page_end int, extraction_methods array<string>"
    good = (0, "a", "t", "zh", "cnki_pdf", "p", "字" * 60, "d", [1], 1, 1, ["ocr"])
    ready = V.corpus_report(spark.createDataFrame([good], schema), language="zh").first()
    assert ready["ready_for_common_embedding"] and ready["language_counts"] == {"zh": 1}
    bad = [good, (1, "a", "", "zh", "cnki_pdf", "p", "短", "d", [], 0, 1, ["ocr"]), (2, "", "t", "zh", "x", "p", "t", "d", [1], 1, 1, ["ocr"])]
    issues = [(r["row_index"], r["issue"]) for r in V.corpus_issues(spark.createDataFrame(bad, schema)).collect()]
    assert sorted(issues) == [(1, "duplicate_chunk_id"), (1, "missing_fields"), (1, "short_text"), (2, "missing_fields")]
    vectors = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "row_index int, embedding array<float>")
    meta = spark.createDataFrame([(0, "a", "x", "zh", "t", "p", [1]), (2, "a", "", "en", "", "", None)], "row_index int, chunk_id string, text string, language string, title string, source_path string, source_pages array<int>").withColumn("position", F.when(F.col("row_index") == 0, 0).otherwise(1))
    r = V.index_report(vectors, meta, vectors, {"embedding_manifest": {"chunk_count": 2, "embedding_dim": 2}}, language="zh").first()
    assert not r["ready_for_retrieval"] and {"metadata_row_index_mismatch", "duplicate_chunk_id", "empty_chunk_text", "unexpected_language", "missing_source_pages"} <= set(r["issues"])
    assert V.sample_rows(0) == [] and V.sample_rows(1) == [0] and V.sample_rows(9) == [0, 4, 8]


def test_smoke(spark):
    hits = spark.createDataFrame([("q", 1, 0, "c", "Title", "S", "has Rifampicin", "p", [1]), ("r", 1, 1, "d", "T", "S", "x", "p", None)], "query_id string, rank int, row_index int, chunk_id string, title string, section string, text string, source_path string, source_pages array<int>")
    asked = spark.createDataFrame([("q", "?", ["RIFAMPICIN", "zzz"]), ("r", "?", ["x"]), ("s", "?", ["x"])], "query_id string, query string, expected_any array<string>")
    got = {r["query_id"]: r for r in V.smoke_results(asked, hits).collect()}
    assert got["q"]["passed"] and got["q"]["matched_keywords"] == ["RIFAMPICIN"] and got["r"]["missing_traceability"] == ["d"] and not got["r"]["passed"] and not got["s"]["passed"]
    assert V.smoke_totals(V.smoke_results(asked, hits)).first()["failed_count"] == 2


def test_chunks_of_records(spark):
    records = spark.createDataFrame([("r1", "PMC1", "7", "", "T", "abs"), ("r2", "", "9", "", "T", "only abstract"), ("r3", "", "", "", "", "")], "record_id string, pmcid string, pmid string, doi string, title string, abstract string")
    chunks = spark.createDataFrame([(1, "c1", "PMC1", "7", "x"), (2, "c1", "PMC1", "", "again"), (3, "c2", "", "7", "y"), (4, "", "PMC1", "", "z")], "seq int, chunk_id string, pmcid string, pmid string, text string")
    got = sorted((r["record_id"], r["chunk_id"], r["text"]) for r in S.chunks_of_records(records, chunks).collect())
    assert got == [("r1", "c1", "x"), ("r1", "c2", "y"), ("r1", "row:4", "z"), ("r2", "pmid:9::registry_abstract", "only abstract")]

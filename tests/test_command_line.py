"""The command line from sources to evidence on a tiny corpus."""

import json

from quillspark.__main__ import main
from tests.test_sources import JATS


def test_from_registry_to_evidence(spark, tmp_path):
    src, xml = tmp_path / "src", tmp_path / "xml"
    src.mkdir(), xml.mkdir()
    text = "Patients with idiopathic granulomatous mastitis were given antibiotic treatment and followed for two years. They did well."
    (src / "pubmed_core.csv").write_text(f"pmid,pmcid,doi,title,journal,year,abstract,source_url\n1,,,Granulomatous mastitis in women,J,2020,{text},\n2,,,Dairy cows,J,2020,Bovine mastitis of the udder in a herd of cattle.,\n")
    (xml / "PMC1.xml").write_text(JATS)
    at = lambda name: str(tmp_path / name)
    assert main(["merge-registry", str(src), at("registry")]) == 0
    assert json.loads((tmp_path / "registry-summary.json").read_text())["total"] == 2
    assert main(["merge-registry", str(tmp_path / "none"), at("x")]) == 2
    assert main(["chunk-abstracts", at("registry"), at("abstracts")]) == 0
    assert main(["parse-articles", str(xml), at("paragraphs"), "--min-chars", "20"]) == 0
    assert main(["chunk-articles", at("paragraphs"), at("full")]) == 0
    assert main(["combine-chunks", at("abstracts"), at("full"), at("chunks")]) == 0
    assert main(["filter-corpus", at("registry"), at("chunks"), at("filtered")]) == 0
    routed = {r["chunk_id"]: r["bucket"] for r in spark.read.parquet(at("filtered/chunks")).collect()}
    assert routed["PMID1::Abstract::001"] == "strict" and routed["PMID2::Abstract::001"] == "excluded" and len(routed) > 3
    assert main(["check-corpus", at("chunks"), at("report.json")]) in (0, 2)
    assert main(["build-index", at("chunks"), at("index")]) == 0
    assert main(["search-chunks", at("index"), "granulomatous mastitis antibiotic treatment", at("found"), "--top-k", "2"]) == 0
    found = sorted(spark.read.json(at("found/evidence")).collect(), key=lambda r: r["rank"])
    assert [r["evidence_id"] for r in found] == ["E1", "E2"] and found[0]["chunk_id"] == "PMID1::Abstract::001"
    assert main(["run-query", "none", "x", at("y")]) == 2

"""Command line: ``python -m quillspark COMMAND ...``. Exit code 0, or 2 for missing input or failed units."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark import catalog, models
from quillspark.functions import text
from quillspark.operators import assess, chunking, classify, evaluate, pages, registry, retrieval, semantic, validate
from quillspark.sources import articles, files, pdf, pubmed, sinks
from quillspark.storage import with_row_number


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def search_literature(spark: SparkSession, a: argparse.Namespace) -> int:
    queries = files.pubmed_queries(a.config)
    sinks.write_per_query(pubmed.search(spark, {k: q for k, q in queries.items() if not a.key or k in a.key}, a.most, a.answers), a.out)
    return 0


def merge_registry(spark: SparkSession, a: argparse.Namespace) -> int:
    rows = files.read_sources(spark, files.discover_sources(a.source))
    if rows is None:
        return 2
    merged = registry.merge(rows, fields=[f for f in registry.FIELDS if f in rows.columns])
    merged.write.mode("overwrite").parquet(a.out)
    sinks.write_json(f"{a.out}-summary.json", {r["measure"]: r["n"] for r in registry.summary(spark.read.parquet(a.out)).collect()})  # a row for each source
    return 0


def parse_articles(spark: SparkSession, a: argparse.Namespace) -> int:
    parsed = articles.read_articles(spark, a.source, least=a.min_chars)
    parsed.write.mode("overwrite").parquet(a.out)
    return 2 if spark.read.parquet(a.out).where("status = 'failed'").limit(1).count() else 0


def chunk_abstracts(spark: SparkSession, a: argparse.Namespace) -> int:
    chunking.abstract_chunks(registry.abstract_only(spark.read.parquet(a.source), a.all), a.words).write.mode("overwrite").parquet(a.out)
    return 0


def chunk_articles(spark: SparkSession, a: argparse.Namespace) -> int:
    rows = spark.read.parquet(a.source).where("status = 'parsed'")
    facts = [F.first(c).alias(c) for c in ("pmid", "doi", "title", "journal", "year", "source_path")]
    from quillspark.functions.sentences import paragraph_sentences

    rows = assess.selected(rows, a.select, "title", "source_path")
    sections = rows.groupBy("pmcid", "section").agg(*facts, F.collect_list(F.struct("paragraph_index", "text")).alias("p")).withColumn("sentences", paragraph_sentences("p")).drop("p")
    return _chunked(spark, models.semantic_cuts(assess.first_rows(sections, a.limit, ["pmcid", "section"])), chunking.section_chunks, chunking.EN, ["pmcid", "section"], a.out)


def _chunked(spark: SparkSession, cut: DataFrame, make, limits: chunking.Limits, key: list[str], out: str) -> int:
    """Chunks of the sections that could be cut, and a manifest of all."""
    cut.write.mode("overwrite").parquet(f"{out}-sections")
    cut = spark.read.parquet(f"{out}-sections")
    make(cut.where("error is null"), limits).write.mode("overwrite").parquet(out)
    manifest = models.chunk_manifest(cut, spark.read.parquet(out), key)
    sinks.write_csv(manifest, f"{out}-manifest", mode="overwrite")
    return 2 if cut.where("error is not null").limit(1).count() else 0


def fetch_articles(spark: SparkSession, a: argparse.Namespace) -> int:
    transport = pubmed.from_folder(a.answers) if a.answers else pubmed.over_network
    got = pubmed.fetch_articles(assess.first_rows(spark.read.parquet(a.registry), a.limit, ["pmcid"]), transport=transport)
    got.write.mode("overwrite").parquet(a.out)
    return 0


def second_pass(spark: SparkSession, a: argparse.Namespace) -> int:
    """Checks what filter-corpus kept for animal studies: reads its folder, writes final registry, chunks, audit and report."""
    records = with_row_number(spark.read.parquet(f"{a.filtered}/registry").withColumn("record_id", F.col("dedupe_key")).drop("seq"), ["record_id"], "seq")
    chunks = with_row_number(_chunks(spark, f"{a.filtered}/chunks"), ["chunk_id"], "seq")
    found = {label: semantic.anchors(chunks.where(F.col("bucket") == bucket), label, most=a.most_anchors) for label, bucket in (("animal", "excluded"), ("human", "strict"))}
    counts = {label: f.count() for label, f in found.items()}
    if min(counts.values()) < a.least_anchors:
        print(f"too few anchors: {counts}", file=sys.stderr)
        return 2
    kept = assess.with_status(strict=records.where("bucket = 'strict'"), review=records.where("bucket = 'review'"))
    anchors = found["animal"].unionByName(found["human"])
    done = assess.assess_records(assess.first_rows(kept, a.limit, ["status", "seq"]), chunks, anchors, models.encoder_udf(models.HashingEncoder))
    done.write.mode("overwrite").parquet(f"{a.out}/audit")
    done = spark.read.parquet(f"{a.out}/audit")
    whole = assess.annotate(done, records.where("bucket = 'excluded'"))
    sinks.write_buckets(whole, f"{a.out}/registry", "semantic_final_status", "overwrite")
    sinks.write_buckets(assess.route(chunks, done, ["chunk_id"]), f"{a.out}/chunks", "final_bucket", "overwrite")
    sinks.write_text(f"{a.out}/report.md", sinks.semantic_report(whole, semantic.Thresholds(), counts))
    return 0


def parse_pdfs(spark: SparkSession, a: argparse.Namespace) -> int:
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(a.source).select("path", "content")
    found = assess.selected(found, a.select, "path")
    found = found if a.limit is None else found.join(assess.by_name(found.select("path")).limit(a.limit), "path", "left_semi")
    pdf.read_pages(found, pdf.CommandLine(), a.ocr).write.mode("overwrite").parquet(f"{a.out}/pages")
    read = spark.read.parquet(f"{a.out}/pages")
    failed = read.where("error is not null").select("document_id", "title", "source_path", F.concat(F.lit("failed: "), "error").alias("status"))
    whole = pages.page_totals(read.where("error is null")).join(read.where("error is null").select("document_id", "title", "source_path").distinct(), "document_id").withColumn("status", F.lit("parsed")).unionByName(failed, allowMissingColumns=True)
    assess.registry_record(whole).write.mode("overwrite").parquet(f"{a.out}/registry")
    sinks.write_text(f"{a.out}/report.md", sinks.parse_report(whole))
    return 2 if failed.limit(1).count() else 0


def chunk_documents(spark: SparkSession, a: argparse.Namespace) -> int:
    read = assess.selected(spark.read.parquet(a.source).where("error is null"), a.select, "title", "source_path")
    facts = read.groupBy("document_id").agg(*(F.first(c).alias(c) for c in ("title", "journal", "year", "doi", "source_path")))
    sections = assess.first_rows(pages.sections(read, a.references).join(facts, "document_id"), a.limit, ["document_id", "first"])
    key = ["document_id", "section"]
    return _chunked(spark, models.semantic_cuts(sections, limits=chunking.CJK, glue="", key=key), chunking.section_chunks_cjk, chunking.CJK, key, a.out)


def filter_documents(spark: SparkSession, a: argparse.Namespace) -> int:
    records = classify.classify_records_cjk(spark.read.parquet(a.registry))
    known = records.select("document_id", F.col("decision").alias("article"))
    chunks = classify.classify_chunks_cjk(_chunks(spark, a.chunks)).join(known, "document_id", "left")
    sinks.write_buckets(records.select("*", classify.bucket(F.col("decision.decision")).alias("bucket")), f"{a.out}/registry", mode="overwrite")
    sinks.write_buckets(classify.route_chunks_cjk(chunks), f"{a.out}/chunks", mode="overwrite")
    sinks.write_text(f"{a.out}/report.md", sinks.bucket_report(spark.read.parquet(f"{a.out}/chunks"), "Filtered chunks"))
    return 0

def filter_corpus(spark: SparkSession, a: argparse.Namespace) -> int:
    records = with_row_number(classify.classify_records(spark.read.parquet(a.registry)), ["dedupe_key"], "seq")
    chunks = classify.classify_chunks(_chunks(spark, a.chunks))
    routed = classify.route_chunks(classify.with_article(chunks, classify.decisions_by_id(records, "seq"), ["chunk_id"]))
    sinks.write_buckets(records.select("*", classify.bucket(F.col("decision.decision")).alias("bucket")), f"{a.out}/registry", mode="overwrite")
    sinks.write_buckets(routed, f"{a.out}/chunks", mode="overwrite")
    return 0


def combine_chunks(spark: SparkSession, a: argparse.Namespace) -> int:
    parts = [with_row_number(_chunks(spark, p), ["chunk_id"], "seq") for p in a.sources]
    registry.combine(parts).write.mode("overwrite").parquet(a.out)
    return 0


def check_corpus(spark: SparkSession, a: argparse.Namespace) -> int:
    found = validate.corpus_report(with_row_number(_chunks(spark, a.chunks), ["chunk_id"]), language=a.language)
    sinks.write_row(found, a.out)
    return 0 if found.first()["ready_for_common_embedding"] else 2


def build_index(spark: SparkSession, a: argparse.Namespace) -> int:
    rows = with_row_number(_chunks(spark, a.chunks), ["chunk_id"])
    embedded = models.embed(rows)
    retrieval.build_index(registry.metadata(embedded).join(embedded.select("row_index", "embedding"), "row_index")).write.mode("overwrite").parquet(a.out)
    sinks.write_json(f"{a.out}-manifest.json", sinks.index_manifest(spark.read.parquet(a.out), a.out))
    return 0


def build_checked_index(spark: SparkSession, a: argparse.Namespace) -> int:
    """Parts combined, checked, indexed and the index checked: the strict English or the Chinese index."""
    parts = [with_row_number(_chunks(spark, p), ["chunk_id"], "seq") for p in a.sources]
    registry.combine(parts).write.mode("overwrite").parquet(f"{a.out}/chunks")
    chunks = argparse.Namespace(chunks=f"{a.out}/chunks", out=f"{a.out}/corpus.json", language=a.language)
    if check_corpus(spark, chunks):
        return 2
    build_index(spark, argparse.Namespace(chunks=f"{a.out}/chunks", out=f"{a.out}/index"))
    index = spark.read.parquet(f"{a.out}/index")
    manifest = sinks.index_manifest(index, f"{a.out}/index")
    report = validate.index_report(index.select("row_index", "embedding"), index.drop("embedding"), index.select("row_index", "embedding"), {"index": manifest}, language=a.language)
    sinks.write_row(report, f"{a.out}/index.json")
    return 0 if report.first()["ready_for_retrieval"] else 2


def test_index(spark: SparkSession, a: argparse.Namespace) -> int:
    asked = files.smoke_queries(spark, a.queries)
    index = spark.read.parquet(a.index)
    hits = retrieval.with_metadata(retrieval.search(index, models.embed_queries(asked), a.top_k), index.drop("embedding"))
    results = validate.smoke_results(asked, hits)
    results.write.mode("overwrite").json(f"{a.out}/results")
    sinks.write_row(validate.smoke_totals(results), f"{a.out}/report.json")
    return 0 if validate.smoke_totals(results).first()["all_passed"] else 2


def answer_package(spark: SparkSession, a: argparse.Namespace) -> int:
    """One question's evidence and prompt as files."""
    asked = spark.createDataFrame([("q", a.question)], "query_id string, question string")
    found = models.retrieve_evidence(spark.read.parquet(a.index), asked.withColumnRenamed("question", "query"), top_k=a.top_k)
    prompt = retrieval.prompts(asked, found).first()["prompt"]
    name = a.name or asked.select(text.query_slug("question")).first()[0]
    rows = [r.asDict() for r in found.drop("query_id").orderBy("rank").collect()]  # top_k rows
    sinks.write_rag_package(a.out, a.question, rows, prompt, name)
    return 0


def generate_answer(spark: SparkSession, a: argparse.Namespace, load=None) -> int:
    """An answer to a prompt file by a local model, for reading and as JSON."""
    settings = models.generation_settings(files.read_yaml(a.config))
    asked = spark.createDataFrame([("q", files.read_prompt(a.prompt))], "query_id string, prompt string")
    r = models.generate(asked, load or (lambda: models.LocalModel(settings))).first()
    if r["error"]:
        print(r["error"], file=sys.stderr)
        return 2
    sinks.write_answer(a.out or files.sibling(a.prompt, "answer"), r["answer"], a.prompt, settings)
    return 0


def search_chunks(spark: SparkSession, a: argparse.Namespace) -> int:
    index = spark.read.parquet(a.index)
    asked = spark.createDataFrame([("q", a.question)], "query_id string, query string")
    hits = retrieval.with_metadata(retrieval.search(index, models.embed_queries(asked), a.top_k), index.drop("embedding"))
    found = retrieval.evidence(hits)
    found.write.mode("overwrite").json(f"{a.out}/evidence")
    retrieval.prompts(asked.withColumnRenamed("query", "question"), found).write.mode("overwrite").json(f"{a.out}/prompt")
    return 0


def evaluate_answers(spark: SparkSession, a: argparse.Namespace) -> int:
    df = spark.read.schema("question string, answer string, known_evidence_ids array<string>").json(a.answers)
    evaluate.report(evaluate.evaluate_rules(df), "rules").write.mode("overwrite").json(a.out)
    return 0


def run_query(spark: SparkSession, a: argparse.Namespace) -> int:
    if a.name not in catalog.queries():
        return 2
    catalog.queries()[a.name](spark, a.tables).write.mode("overwrite").parquet(a.out)
    return 0


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="quillspark")
    commands = parser.add_subparsers(required=True)

    def add(f, *positional: str, **options) -> None:
        p = commands.add_parser(f.__name__.replace("_", "-"))
        for name in positional:
            p.add_argument(name, nargs="+" if name == "sources" else None)
        for name, default in options.items():
            flag = f"--{name.replace('_', '-')}"
            if default is False:
                p.add_argument(flag, action="store_true")
            else:
                p.add_argument(flag, default=default, type=type(default) if default is not None else str)
        p.set_defaults(run=f)

    add(search_literature, "out", config=None, most=50, answers=None, key=None)
    add(merge_registry, "source", "out")
    add(parse_articles, "source", "out", min_chars=articles.MIN_CHARS)
    add(chunk_abstracts, "source", "out", words=260, all=False)
    add(chunk_articles, "source", "out", select=None, limit=0)
    add(fetch_articles, "registry", "out", answers=None, limit=0)
    add(second_pass, "filtered", "out", most_anchors=96, least_anchors=assess.LEAST_ANCHORS, limit=0)
    add(parse_pdfs, "source", "out", ocr="auto", select=None, limit=0)
    add(chunk_documents, "source", "out", references=False, select=None, limit=0)
    add(filter_documents, "registry", "chunks", "out")
    add(combine_chunks, "sources", "out")
    add(filter_corpus, "registry", "chunks", "out")
    add(check_corpus, "chunks", "out", language=None)
    add(build_index, "chunks", "out")
    add(build_checked_index, "sources", "out", language=None)
    add(test_index, "index", "queries", "out", top_k=retrieval.TOP_K)
    add(answer_package, "index", "question", "out", top_k=retrieval.TOP_K, name=None)
    add(generate_answer, "prompt", "config", out=None)
    add(search_chunks, "index", "question", "out", top_k=retrieval.TOP_K)
    add(evaluate_answers, "answers", "out")
    add(run_query, "name", "tables", "out")
    return parser


def main(argv: list[str] | None = None) -> int:
    a = _parser().parse_args(argv)
    if getattr(a, "limit", None) == 0:  # no limit asked for
        a.limit = None
    return a.run(SparkSession.builder.appName("quillspark").getOrCreate(), a)


if __name__ == "__main__":
    sys.exit(main())

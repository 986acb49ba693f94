"""Pages of PDF files through an extractor that can be exchanged; external tools run where the file's task runs."""

from __future__ import annotations

import sys
import subprocess
import tempfile
from collections.abc import Iterator
from pathlib import Path, PurePosixPath
from typing import Protocol

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import cjk_chars, content_chars, document_key, extraction_method, given, normalize_page, split_pages
from quillspark.operators.pages import without_margins

#: Functions of this module travel whole, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Extractor(Protocol):
    def native(self, content: bytes) -> tuple[str, int]:
        """Text with a form feed between pages, and the number of pages."""

    def recognise(self, content: bytes, page: int) -> str:
        """Text of one page by recognition."""


class CommandLine:
    """The usual command line tools; a task's temporary files live as long as one call."""

    def __init__(self, languages: str = "chi_sim+eng", dpi: int = 300, timeout: int = 180):
        self.languages, self.dpi, self.timeout = languages, dpi, timeout

    def _run(self, *command: str) -> str:
        return subprocess.run(command, check=True, capture_output=True, timeout=self.timeout).stdout.decode("utf-8", "replace")

    def native(self, content: bytes) -> tuple[str, int]:
        with tempfile.NamedTemporaryFile(suffix=".pdf") as f:
            f.write(content)
            f.flush()
            facts = dict(line.split(":", 1) for line in self._run("pdfinfo", f.name).splitlines() if ":" in line)
            return self._run("pdftotext", "-layout", "-enc", "UTF-8", f.name, "-"), int(facts["Pages"])

    def recognise(self, content: bytes, page: int) -> str:
        with tempfile.TemporaryDirectory() as d:
            (Path(d) / "in.pdf").write_bytes(content)
            self._run("pdftoppm", "-f", str(page), "-l", str(page), "-r", str(self.dpi), "-singlefile", "-png", f"{d}/in.pdf", f"{d}/page")
            return self._run("tesseract", f"{d}/page.png", "stdout", "-l", self.languages, "--psm", "3")


def read_pages(files: DataFrame, extractor: Extractor, ocr_mode: str = "auto", min_output_chars: int = 40) -> DataFrame:
    """Pages of (path, content), margins removed. A file that fails gives one row with its error and no page.

    Recognition runs for the pages that need it alone: they are filtered before the function, not inside a CASE.
    """

    def native(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"]):
                try:
                    rows.append((path, *extractor.native(bytes(content)), None))
                except Exception as problem:
                    rows.append((path, None, None, f"{type(problem).__name__}: {problem}"))
            yield pd.DataFrame(rows, columns=["path", "raw", "page_count", "error"]).astype({"page_count": "Int32"})

    def recognise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"path": batch["path"], "page_number": batch["page_number"], "seen": [extractor.recognise(bytes(c), int(p)) for c, p in zip(batch["content"], batch["page_number"])]})

    read = files.select("path", "content").mapInPandas(native, "path string, raw string, page_count int, error string")
    pages = read.where("error is null").select("path", "page_count", F.posexplode(split_pages("raw", "page_count")).alias("k", "native")).select("path", "page_count", (F.col("k") + 1).alias("page_number"), "native")
    pages = pages.withColumn("extraction_method", extraction_method("native", ocr_mode))
    wanted = pages.where("extraction_method = 'ocr'").select("path", "page_number").join(files.select("path", "content"), "path").mapInPandas(recognise, "path string, page_number int, seen string")
    joined = pages.join(wanted, ["path", "page_number"], "left").withColumn("text", F.when(F.col("extraction_method") == "ocr", normalize_page("seen")).otherwise(F.col("native")))
    stem = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "")
    whole = joined.select(
        document_key(stem).alias("document_id"), stem.alias("title"), *(F.lit("").alias(c) for c in ("journal", "year", "doi")), F.lit("zh").alias("language"), F.lit("cnki_pdf").alias("source_type"), F.col("path").alias("source_path"),
        "page_number", "page_count", "extraction_method", content_chars("native").alias("native_text_char_count"), content_chars("text").alias("text_char_count"), cjk_chars("text").alias("cjk_char_count"),
        (content_chars("text") < min_output_chars).alias("low_text"), given("text").alias("text"), F.lit(None).cast("string").alias("error"),
    )
    failed = read.where("error is not null").select(document_key(stem).alias("document_id"), stem.alias("title"), F.col("path").alias("source_path"), "error")
    return without_margins(whole).unionByName(failed, allowMissingColumns=True)


def document_id(path: str) -> str:
    import hashlib

    return "CNKI-" + hashlib.sha1(PurePosixPath(path).stem.encode()).hexdigest()[:12].upper()

"""Incremental ingestion: files that are new since the last run, once each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quillspark.sources.articles import MIN_CHARS, parse_articles


def new_articles(spark: SparkSession, folder: str, pattern: str = "PMC*.xml", least: int = MIN_CHARS) -> DataFrame:
    """A stream of paragraphs of article files as they arrive."""
    schema = T.StructType().add("path", "string").add("modificationTime", "timestamp").add("length", "long").add("content", "binary")
    files = spark.readStream.schema(schema).format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return parse_articles(files, least)


def ingest(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append what is new to a Parquet table and stop; the checkpoint remembers which files are done."""
    return stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

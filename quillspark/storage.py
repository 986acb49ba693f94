"""Shared storage for cutting lineage, and row numbers over tables of any size."""

from __future__ import annotations

import atexit
import functools
import operator
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, ``spark.checkpoint.dir``. Only a local session may do without the setting."""
    sc = spark.sparkContext
    at = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = getattr(sc, "_quillspark_local", None)
        if not at:
            folder = tempfile.mkdtemp(prefix="quillspark-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
            at = sc._quillspark_local = "file://" + folder
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(at)
    return at


def cut(df: DataFrame) -> DataFrame:
    """The same rows behind a reliable checkpoint."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def with_row_number(df: DataFrame, order: list[str], into: str = "row_index", start: int = 0) -> DataFrame:
    """Contiguous numbers in a total order without gathering the table in one task.

    Rows are range-partitioned and sorted, numbered inside each partition, and moved up by the sizes of the
    partitions before. The numbered partitions are checkpointed so that the sizes belong to the same partitioning. Where the columns of ``order`` tell the rows
    apart, which is checked, only these columns go that way, and the numbers join the rows by key; else whole rows do.
    """
    keys = [f"__k{k}" for k in range(len(order))]
    key = df.groupBy(*(F.col(c).alias(k) for c, k in zip(order, keys))).agg(F.count("*").alias("__n"))
    placed = _placed(key, keys, into, start)
    if (placed.agg(F.max("__n")).first()[0] or 1) > 1:
        return _placed(df, order, into, start)
    same = functools.reduce(operator.and_, (F.col(c).eqNullSafe(F.col(k)) for c, k in zip(order, keys)))
    return df.join(placed.drop("__n"), same).drop(*keys)


def _placed(df: DataFrame, order: list[str], into: str, start: int) -> DataFrame:
    low = F.lit((1 << 33) - 1).cast("bigint")
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = cut(ordered.withColumn("__m", F.monotonically_increasing_id()).withColumn("__p", F.shiftright("__m", 33).cast("int")).withColumn("__i", F.col("__m").bitwiseAND(low)).drop("__m"))
    sizes = placed.groupBy("__p").agg(F.count("*").alias("__size"))  # a row for each partition
    before = sizes.select("__p", (F.sum("__size").over(W.orderBy("__p")) - F.col("__size")).alias("__before"))
    return placed.join(F.broadcast(before), "__p").withColumn(into, F.col("__before") + F.col("__i") + F.lit(start)).drop("__p", "__i", "__before")

"""What the operators of this subpackage share: shipping code, shared storage, word hashing."""

from __future__ import annotations

import atexit
import gc
import io
import shutil
import tempfile
import uuid
import weakref
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch that are worked on at once; keeps a Python worker small when texts are long.
ROWS_AT_ONCE = 256
MASK64 = (1 << 64) - 1


def ship(spark: SparkSession) -> None:
    """Give this package to the executors, once per Spark context."""
    sc = spark.sparkContext
    if getattr(sc, "_quillspark_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    if root.is_dir():
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, str(p.relative_to(root.parent)))
        at = f"{shared_dir(spark)}/quillspark/code-{uuid.uuid4().hex}.zip"
        path = sc._jvm.org.apache.hadoop.fs.Path(at)
        stream = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path)
        stream.write(buffer.getvalue())
        stream.close()
        sc.addPyFile(at)
    sc._quillspark_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. Only a local session may go without it."""
    sc = spark.sparkContext
    at = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not sc.master.startswith("local[") and sc.master != "local":
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
    """The same rows behind a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows as a Parquet table in the shared folder, so that later reads prune columns."""
    spark = df.sparkSession
    at = f"{shared_dir(spark)}/quillspark/{name}-{uuid.uuid4().hex}"
    _tables(spark).append(at)
    df.write.parquet(at)
    return spark.read.schema(df.schema).parquet(at)


def _tables(spark: SparkSession) -> list[str]:
    sc = spark.sparkContext
    if not hasattr(sc, "_quillspark_tables"):
        sc._quillspark_tables = []
    return sc._quillspark_tables


def clean(spark: SparkSession, since: int = 0, keep: int = 0) -> int:
    """Delete the tables that :func:`written` has made after the first ``since``, but for the last ``keep``; how many there are then.

    Only for tables that nothing will read again.
    """
    paths = _tables(spark)
    gone = paths[since : len(paths) - keep]
    for at in gone:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    paths[since : len(paths) - keep] = []
    return len(paths)


def unused(names: list[str], *wanted: str) -> list[str]:
    """The wanted names, with underscores before them as far as needed to be none of ``names``, whatever the case."""
    taken, out = {n.lower() for n in names}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
        taken.add(name.lower())
    return out


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of steps that nothing refers to any more; Spark does so when the driver's garbage is collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id bigint, text string), whatever else the table holds."""
    return df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sliced(batches: Iterable[pa.RecordBatch], rows: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, rows: int = ROWS_AT_ONCE) -> DataFrame:
    """mapInArrow with batches of bounded rows; ``work`` may return None for no rows."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, rows):
            out = work(part)
            if out is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)


class Bounded(dict):
    """A memo that forgets everything when it is full: any size of input, bounded memory.

    A worker outlives the operators that run in it, so memos that have made nothing while others made ``IDLE`` entries are emptied.
    """

    IDLE = 50_000
    _made = 0
    _all: list[weakref.ref] = []

    def __init__(self, make: Callable, most: int = 400_000):
        super().__init__()
        self.make, self.most, self.used = make, most, False
        Bounded._all.append(weakref.ref(self))

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        self.used = True
        Bounded._made += 1
        if Bounded._made >= self.IDLE:
            Bounded._made = 0
            self._empty_idle()
        value = self[key] = self.make(key)
        return value

    @staticmethod
    def _empty_idle() -> None:
        live = [(r, m) for r in Bounded._all if (m := r()) is not None]
        Bounded._all[:] = [r for r, _ in live]
        for _, memo in live:
            if not memo.used:
                memo.clear()
            memo.used = False


def hash64(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))


_WORD_HASHES = Bounded(hash64)


def word_hashes(words: list[str]) -> np.ndarray:
    """64-bit hashes of words, looked up in a worker-wide memo."""
    return np.fromiter(map(_WORD_HASHES.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BASE = 0x9E3779B97F4A7C15 | 1
_INV_BASE = pow(_BASE, -1, 1 << 64)
_POWERS = np.ones(1, np.uint64)
_INVERSES = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS, _INVERSES
    if len(_POWERS) < n:
        size = max(n, 2 * len(_POWERS), 1024)
        with np.errstate(over="ignore"):
            for base, name in ((_BASE, "_POWERS"), (_INV_BASE, "_INVERSES")):
                x = np.full(size, base, np.uint64)
                x[0] = 1
                globals()[name] = np.cumprod(x, dtype=np.uint64)
    return _POWERS[:n], _INVERSES[:n]


def prefix_hashes(values: np.ndarray) -> np.ndarray:
    """Prefix sums of values[i] * base**i modulo 2**64; entry i covers the first i values."""
    out = np.zeros(len(values) + 1, np.uint64)
    powers, _ = _powers(len(values))
    np.cumsum(values * powers, out=out[1:])
    return out


def window_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """Polynomial hash of every window of ``width`` values, equal wherever the windows are equal."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    p = prefix_hashes(values)
    _, inverses = _powers(n)
    return mix((p[width:] - p[:-width]) * inverses)


def span_hashes(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The hash of :func:`window_hashes` for windows of any widths."""
    p = prefix_hashes(values)
    _, inverses = _powers(len(p))
    return mix((p[end] - p[begin]) * inverses[begin])


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str | None]:
    return batch.column(batch.schema.get_field_index(column)).to_pylist()


def lists(values: np.ndarray, lengths: np.ndarray | list[int], kind: pa.DataType, valid: np.ndarray | None = None) -> pa.ListArray:
    """An Arrow list column from flat values and a length for each row."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    mask = None if valid is None else pa.array(~valid)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind), mask=mask)

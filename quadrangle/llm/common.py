"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: A word: a run of characters that are neither a space nor one of \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or, in local mode, a folder of our own where that is unset."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not path:
        path = tempfile.mkdtemp(prefix="quadrangle-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: cuts lineage and survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/quadrangle/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once an application: they need not find it on their own path."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[1]
        path = Path(tempfile.mkdtemp(prefix="quadrangle-")) / "quadrangle.zip"  # on the driver; Spark serves it to the executors
        with zipfile.ZipFile(path, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        context.addPyFile(str(path))
        _shipped.add(context.applicationId)


@contextmanager
def short_plans(spark: SparkSession) -> Iterator[None]:
    """While jobs run in rounds: the driver keeps the text of each job's plan, which is cut to some lines."""
    ours = {"spark.sql.maxPlanStringLength": "2000", "spark.sql.ui.explainMode": "simple"}
    before = {k: spark.conf.get(k) for k in ours}
    for k, v in ours.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder; the session sends Arrow batches of some megabytes instead of 64."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; null ids count as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


#: Bytes of a record batch that a worker turns into Python objects at once; a longer row is a slice by itself.
SLICE_BYTES = 4_000_000


def lean(function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """For mapInArrow: the function sees slices of a few megabytes, and the worker returns its memory when a task ends.

    Workers live on from task to task and from stage to stage; without this each
    keeps what its largest task once took.
    """

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = max(1, SLICE_BYTES * len(batch) // max(batch.nbytes, 1))
            yield from (batch.slice(at, rows) for at in range(0, len(batch), rows))

    @wraps(function)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(sliced(batches))
        finally:
            release()

    return run


def release() -> None:
    """Give freed memory of this process back to the operating system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

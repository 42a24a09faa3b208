"""What the operators of this subpackage share: tables, scratch space, worker-side caches."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from ..sources import scratch

#: Rows and bytes that Spark hands to a Python worker at once: texts are long, and workers share a small memory.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch limits to what whole texts need (a lower setting stays).

    They stay lower: Spark reads them when a result is computed, which is after the operator has returned it.
    """
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    try:
        limit = int(spark.conf.get(name))
    except (PySparkException, ValueError):
        return  # this version has no such limit, or it has a unit
    if not 0 < limit <= BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def give_back() -> None:
    """Hand freed memory back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def released(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A batch function that hands freed memory back to the system when its task ends: workers idle on between tasks."""

    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One table of a data directory, through Spark's own reader."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


class Scratch:
    """Tables written once in the shared scratch folder, so that a lost executor costs no recomputation of what led to them.

    Operators drop what their result does not read; the rest is deleted when the session's JVM ends.
    """

    def __init__(self, spark: SparkSession, tag: str):
        small_batches(spark)
        self.spark = spark
        self.base = f"{scratch.root(spark)}/{tag}-{uuid.uuid4().hex}"
        scratch.delete_at_end(spark, self.base)
        self._n = 0

    def keep(self, df: DataFrame, name: str = "t") -> DataFrame:
        """Write ``df`` as Parquet and return a reader of what was written: its lineage starts at the files."""
        self._n += 1
        path = f"{self.base}/{self._n:02d}-{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str, but: tuple[str, ...] = ()) -> None:
        """Delete tables that nothing reads any more: those named, or all of this scratch but ``but``."""
        root, fs = scratch.filesystem(self.spark, self.base)
        if not fs.exists(root):
            return
        for st in fs.listStatus(root):
            name = st.getPath().getName().split("-", 1)[-1]
            if name in names if names else name not in but:
                fs.delete(st.getPath(), True)


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Column names that ``df`` does not use, one for each wanted name (case ignored, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out

"""Intermediate tables in the shared folder of ``spark.checkpoint.dir``: written once, read often, safe from lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def root(spark: SparkSession) -> str:
    """The shared folder; a temporary one only where none is set, which ends with the session's JVM."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared:
        return shared.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = "file://" + tempfile.mkdtemp(prefix="korrel-")
        delete_at_end(spark, _OWN[app])
    return _OWN[app]


def filesystem(spark: SparkSession, path: str):
    """(path, file system) of Hadoop for a path."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_at_end(spark: SparkSession, path: str) -> None:
    """Delete a path when the session's JVM ends."""
    p, fs = filesystem(spark, path)
    fs.deleteOnExit(p)


def kept(df: DataFrame, tag: str = "table") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and return a reader of it; deleted when the session's JVM ends."""
    spark = df.sparkSession
    path = f"{root(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    delete_at_end(spark, path)
    return spark.read.schema(df.schema).parquet(path)

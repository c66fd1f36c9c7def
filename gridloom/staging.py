"""Tables between steps, in the folder that all machines share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Spark drops the shuffle files of a finished execution at once, not at the driver's next collection.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a folder of our own only where it is unset and the master is this machine.

    On a cluster without the setting this is an error: executors would write to their own disks and read nothing back.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="gridloom-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def stage(df: DataFrame, name: str, compression: str = "snappy", by: str | None = None) -> DataFrame:
    """Write df once and read it back: later steps do not compute it again, and lost executors do not lose it.

    Shuffle files of the write go when it ends, the table when the application ends or with `discard`.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", compression)
    with _setting(spark, CLEANUP, "true"):
        (writer.partitionBy(by) if by else writer).parquet(path)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete tables of `stage` that no later plan reads."""
    for df in frames:
        if path := getattr(df, "_staged_path", None):
            spark = df.sparkSession
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)

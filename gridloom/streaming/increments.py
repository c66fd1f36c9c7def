"""New grid files as a stream: each is parsed once and appended, which makes re-runs over new years incremental."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridloom.sources.files import csv_cells

FILES = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def stream_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Cells of CSV files as they arrive below folder."""
    files = spark.readStream.format("binaryFile").schema(FILES).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").load(folder)
    return csv_cells(files).withColumn("table_id", F.regexp_extract("path", r"([^/]+)\.csv$", 1))


def append_new(spark: SparkSession, folder: str, out: str, checkpoint: str) -> StreamingQuery:
    """Process what is new and stop; the checkpoint remembers the files that were read."""
    return stream_cells(spark, folder).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

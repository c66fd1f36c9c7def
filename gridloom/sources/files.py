"""Grids and dictionaries from files. Files are read by Spark, so any store that Spark reaches will do."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import text as X
from gridloom.model import IDENTIFIER

CELLS = "path string, row_index int, col_index int, cell_value string"


def listing(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """path, name, length and modification time of all files below folder, once each."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder).select("path", "length", "modificationTime")
    return files.withColumn("name", F.element_at(F.split("path", "/"), -1)).dropDuplicates(["path", "name"])


def file_summary(files: DataFrame) -> DataFrame:
    """Extension, files and years found in the paths."""
    year = F.nullif(F.regexp_extract("path", "/([0-9]{4})/", 1), F.lit(""))
    return files.groupBy(F.regexp_extract("name", r"\.([^.]*)$", 1).alias("extension")).agg(F.count("*").alias("files"), F.sort_array(F.collect_set(year)).alias("years"))


def by_year_and_chapter(files: DataFrame, years: list[int], chapters: list[int]) -> DataFrame:
    """Files in a year's folder whose name begins with a wanted chapter."""
    in_year = F.exists(F.array(*[F.lit(f"/{y}/") for y in years]), lambda y: F.contains("path", y))
    return files.filter(in_year & F.regexp_extract("name", r"^0*([0-9]+)\.", 1).try_cast("int").isin(*chapters))


def _parse_csv(data: bytes) -> list[list[str]]:
    return list(csv.reader(io.StringIO(data.decode("utf-8-sig", "replace"), newline="")))


def _emit(rows: Iterator[tuple], names: str) -> Iterator[pa.RecordBatch]:
    kinds = {"string": pa.string(), "int": pa.int32(), "binary": pa.binary(), "array<array<string>>": pa.list_(pa.list_(pa.string()))}
    fields = [f.rsplit(" ", 1) for f in names.split(", ")]
    block: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*block, strict=True), fields, strict=True)], names=[n for n, _ in fields])

    for row in rows:
        block.append(row)
        if len(block) >= 20_000:
            yield batch()
            block = []
    if block:
        yield batch()


def csv_cells(files: DataFrame) -> DataFrame:
    """Cells of CSV files (path, content): exact row and column numbers, strings only, quoted line breaks kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            (path, r, c, value)
            for b in batches
            for path, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)
            for r, row in enumerate(_parse_csv(data))
            for c, value in enumerate(row)
        )
        yield from _emit(rows, CELLS)

    return files.select("path", "content").mapInArrow(run, CELLS)


def read_csv_grids(spark: SparkSession, folder: str, header_before: int | None = 2017) -> DataFrame:
    """table_id, year and cells of every CSV below folder, stars removed.

    A table is a file year/chapter/id.csv, or a folder table_id=id as `write_grids` makes it. The first line of files of
    years before header_before is a line of column labels and is dropped.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").load(folder)
    named = F.regexp_extract("path", "/table_id=([^/]+)/", 1)  # Spark writes special characters as %XX
    ident = F.when(named != "", F.url_decode(F.replace(named, F.lit("+"), F.lit("%2B")))).otherwise(F.regexp_extract("path", r"([^/]+)\.csv$", 1))
    year = F.coalesce(F.regexp_extract(ident, IDENTIFIER, 3).try_cast("int"), F.regexp_extract("path", "/(?:year=)?([0-9]{4})/", 1).try_cast("int"))
    cells = csv_cells(files).select(ident.alias("table_id"), year.alias("year"), "row_index", "col_index", X.strip_stars(F.col("cell_value")).alias("cell_value"))
    if header_before is None:
        return cells
    old = F.coalesce(F.col("year") < header_before, F.lit(False))
    return cells.filter(~old | (F.col("row_index") > 0)).withColumn("row_index", F.when(old, F.col("row_index") - 1).otherwise(F.col("row_index")))


def clean_csv_text(replies: DataFrame, key: str, text: str) -> DataFrame:
    """Cells of CSV text from a model: stars off the header, rows padded; replies of one column or none are rejected."""
    out = f"{key} string, row_index int, col_index int, cell_value string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for b in batches:
                for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    grid = _parse_csv((t or "").strip().encode())
                    width = max(map(len, grid), default=0)
                    if width < 2 or (t or "").strip().lower() == "null":
                        continue
                    for r, row in enumerate(grid):
                        for c in range(width):
                            value = row[c] if c < len(row) else ""
                            yield k, r, c, value.rstrip("*") if r == 0 else value

        yield from _emit(rows(), out)

    return replies.select(F.col(key).cast("string").alias(key), text).mapInArrow(run, out)


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """id, header and the id's parts from JSON objects id -> header; ids of another form are dropped.

    A missing file and one that is no JSON object give no rows, so names fall back to ids.
    """
    raw = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True) if exists(spark, path) else spark.createDataFrame([], "value string")
    pairs = raw.select(F.explode(F.from_json("value", "map<string,string>")).alias("id", "header"))
    part = lambda i: F.regexp_extract("id", f"^{IDENTIFIER}$", i).try_cast("int")
    return pairs.select("id", "header", part(1).alias("serial"), part(2).alias("chapter"), part(3).alias("year")).filter("serial is not null")


def names_or_ids(tables: DataFrame, names: DataFrame | None, ident: str = "table_id") -> DataFrame:
    """Adds table_name: from names (id, header) where known, else the id."""
    if names is None:
        return tables.withColumn("table_name", F.col(ident))
    return tables.join(names.select(F.col("id").alias(ident), F.col("header").alias("_h")), ident, "left").withColumn("table_name", F.coalesce("_h", ident)).drop("_h")


CHAIN_FILE = "map<string,struct<id:string,tables:array<string>,years:array<int>,headers:array<string>,mask_references:array<string>,status:string,gaps:array<int>,similarities:array<double>,api_validated:array<boolean>>>"


def read_chains(spark: SparkSession, path: str, prefix: bool = True) -> DataFrame:
    """One row a chain of chains_chapter_N.json files, or of folders chapter_id=N as `write_chains` makes them; prefix: ids become ch{N}_id, as several chapters need."""
    place = F.coalesce(F.nullif(F.regexp_extract(F.col("_metadata.file_path"), "/chapter_id=([0-9]+)/", 1), F.lit("")), F.regexp_extract(F.col("_metadata.file_name"), "([0-9]+)", 1))
    raw = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).select(place.try_cast("int").alias("chapter_id"), F.explode(F.from_json("value", CHAIN_FILE)).alias("key", "c"))
    ident = F.concat(F.lit("ch"), F.col("chapter_id").cast("string"), F.lit("_"), "key") if prefix else F.col("key")
    return raw.select("chapter_id", ident.alias("chain_id"), "c.*").drop("id")


def chain_links(chains: DataFrame) -> DataFrame:
    """Parallel lists of chains as rows."""
    some = lambda c, name, kind: F.coalesce(F.col(c), F.array().cast(f"array<{kind}>")).alias(name)  # noqa: E731  an absent list leaves nulls
    lists = F.arrays_zip(
        "years", some("tables", "table_id", "string"), some("headers", "header", "string"), some("mask_references", "mask_reference", "string"), some("similarities", "similarity", "double"), some("api_validated", "api_validated", "boolean")
    )
    return chains.select("chapter_id", "chain_id", F.posexplode(lists).alias("seq", "x")).select("chapter_id", "chain_id", "seq", F.col("x.years").alias("year"), "x.table_id", "x.header", "x.mask_reference", "x.similarity", "x.api_validated")


def mask_table_id(path: Column) -> Column:
    return F.regexp_extract(path, r"([0-9]+_[0-9]+_[0-9]+)\.csv", 1)


def skip_existing(tables: DataFrame, manifest: DataFrame, key: str = "table_id") -> DataFrame:
    return tables.join(manifest.select(key).distinct(), key, "left_anti")

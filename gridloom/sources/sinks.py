"""Writers: grids, dictionaries, long tables, status and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.text import sanitize_name
from gridloom.operators.grid import pivot
from gridloom.operators.tables import seed_pending, upsert


def write_grids(cells: DataFrame, path: str, width: int, by: tuple[str, ...] = ("year", "chapter")) -> None:
    """One folder a table below year and chapter, rows in order."""
    keys = (*by, "table_id", "row_index")
    wide = pivot(cells, width, keys)
    wide.repartition(*by, "table_id").sortWithinPartitions("table_id", "row_index").drop("row_index").write.mode("overwrite").partitionBy(*by, "table_id").option("emptyValue", "").csv(path)


def titled_rows(titles: DataFrame, names: DataFrame, cells: DataFrame) -> DataFrame:
    """Title row, column row and data rows of each table under one another; table_id, row_index, col_index, cell_value."""
    a = titles.select("table_id", F.lit(0).alias("row_index"), F.lit(0).alias("col_index"), F.col("title").alias("cell_value"))
    b = names.select("table_id", F.lit(1).alias("row_index"), "col_index", F.col("name").alias("cell_value"))
    return a.union(b).union(cells.select("table_id", F.col("row_index") + 2, "col_index", "cell_value"))


def write_dictionary(pairs: DataFrame, path: str, key: str, value: str) -> None:
    """One JSON object a line; a file a task, so nothing is gathered."""
    pairs.select(F.to_json(F.struct(F.col(key).alias("id"), F.col(value).alias("header"))).alias("value")).write.mode("overwrite").text(path)


def write_names(pairs: DataFrame, path: str, by: str = "chapter") -> None:
    """id -> header as one JSON object a chapter, which `read_dictionary` reads. A chapter's names are one row."""
    whole = F.to_json(F.map_from_entries(F.collect_list(F.struct("id", "header")))).alias("value")
    pairs.groupBy(by).agg(whole).repartition(by).write.mode("overwrite").partitionBy(by).text(path)


CHAIN_FIELDS = ("tables", "years", "headers", "mask_references", "status", "gaps", "similarities", "api_validated", "source_chains", "source_chapters")


def write_chains(chains: DataFrame, path: str, by: str = "chapter_id") -> None:
    """chain id -> its lists as one JSON object a chapter, which `read_chains` reads; fields that chains lack are left out."""
    fields = [c for c in CHAIN_FIELDS if c in chains.columns]
    one = F.struct(F.col("chain_id").alias("id"), *fields)
    whole = F.to_json(F.map_from_entries(F.collect_list(F.struct("chain_id", one)))).alias("value")
    chains.groupBy(by).agg(whole).repartition(by).write.mode("overwrite").partitionBy(by).text(path)


def chain_metadata(links: DataFrame, chapters: DataFrame | None = None) -> DataFrame:
    """One row a chain: table count, years and the years missing between; chapters (chapter_id, chapter_name) names them."""
    rows = links.groupBy("chapter_id", "chain_id").agg(F.count("*").cast("int").alias("table_count"), F.sort_array(F.collect_set("year")).alias("years"))
    rows = rows.withColumn("gaps", F.array_except(F.sequence(F.array_min("years"), F.array_max("years")), "years"))
    return rows if chapters is None else rows.join(chapters, "chapter_id", "left")


def wide(merged: DataFrame, names: list[str], chain: str = "chain_id") -> DataFrame:
    """The merged table of chains that share column names: a row a year and row, meta_year first."""
    value = lambda n: F.max(F.when(F.col("column_name") == n, F.col("cell_value"))).alias(n)
    return merged.groupBy(chain, "meta_year", "row_index").agg(*[value(n) for n in names]).select("meta_year", chain, "row_index", *names)


def report_lines(report: DataFrame, key: str = "chain_id") -> DataFrame:
    """A line of text a chain of a validation report."""
    state = F.when(F.col("valid"), "ok").otherwise(F.concat(F.lit("failed: "), "issues"))
    return report.select(F.format_string("%s: %d rows, %d columns, %d years, %s", F.col(key).cast("string"), "n_rows", "n_columns", "n_years", state).alias("value"))


def write_lines(lines: DataFrame, path: str) -> None:
    lines.select("value").write.mode("overwrite").text(path)


def kept_files(files: DataFrame, flags: DataFrame, key: str = "name", flag: str = "redundant") -> DataFrame:
    """The list of files to copy: those not flagged YES. Copying is the storage's job."""
    from gridloom.operators.tables import keep_unflagged

    return keep_unflagged(files, flags, key, flag)


def upsert_dictionary(spark: SparkSession, new: DataFrame, old_path: str, new_path: str, keys: tuple[str, ...]) -> None:
    """Old entries with new ones over them, written beside the old table; the caller swaps the folders."""
    upsert(spark.read.parquet(old_path), new, keys).write.mode("overwrite").parquet(new_path)


def create_if_absent(spark: SparkSession, table: str, schema: str, partition: str | None = None) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({schema}) USING parquet" + (f" PARTITIONED BY ({partition})" if partition else ""))


def append_rows(rows: DataFrame, table: str) -> None:
    rows.select(*rows.sparkSession.table(table).columns).write.mode("append").insertInto(table)


def seed_status(source: DataFrame, status: DataFrame, key: str = "chain_id") -> DataFrame:
    return status.unionByName(seed_pending(source, status, key))


def replace_chains(rows: DataFrame, path: str, key: str = "chain_id") -> None:
    """Replace the written chains' partitions only; others stay. Rows are dealt by chain, so a chain is one file."""
    rows.repartition(key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def finish_status(status: DataFrame, done: DataFrame, failed: DataFrame, key: str = "chain_id") -> DataFrame:
    """pending -> completed or failed. The status is a small table of its own, because Parquet has no row update."""
    marks = done.select(key, F.lit("completed").alias("_s")).union(failed.select(key, F.lit("failed").alias("_s"))).groupBy(key).agg(F.max("_s").alias("_s"))
    return status.join(marks, key, "left").withColumn("status", F.coalesce("_s", "status")).drop("_s")


def csv_to_tables(spark: SparkSession, paths: list[str], prefix: str = "") -> list[str]:
    """A managed table a file, types inferred, names made safe. Returns the names."""
    out = []
    for p in paths:
        name = prefix + spark.range(1).select(sanitize_name(F.lit(p.rstrip("/").split("/")[-1].rsplit(".", 1)[0]))).first()[0]
        spark.read.csv(p, header=True, inferSchema=True).write.mode("overwrite").saveAsTable(name)
        out.append(name)
    return out


def write_merged(merged: DataFrame, report: DataFrame, path: str) -> None:
    """The long table by chain, and the chains' report beside it."""
    replace_chains(merged, f"{path}/long")
    report.write.mode("overwrite").json(f"{path}/report")


def union_by_suffix(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """All Parquet tables below folder whose name ends in suffix, as one."""
    return spark.read.option("mergeSchema", "true").parquet(f"{folder}/*{suffix}").withColumn("source_file", F.col("_metadata.file_path"))

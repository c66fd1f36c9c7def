"""Table structure: detection, feature batches, and tables with named columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions import text as X
from gridloom.operators import grid as G
from gridloom.staging import stage

ROW = ("table_id", "row_index")


def structure(cells: DataFrame, masked: DataFrame, marker: str = X.CONTINUATION, marks_first: bool = False) -> DataFrame:
    """table_id and structure. Uneven rows decide first, then continuation marks, then feature rows with gaps.

    marks_first: test continuation marks before uneven rows, so sparse tables reach that case.
    """
    rows = cells.groupBy(*ROW).agg(F.count("cell_value").alias("n"), F.coalesce(F.bool_or(F.col("cell_value").contains(marker)), F.lit(False)).alias("m"))
    flags = rows.groupBy("table_id").agg((F.min("n") < F.max("n")).alias("uneven"), F.bool_or("m").alias("marked"))
    features = G.rows_of_class(masked, "feature")
    jump = F.col("row_index") - F.lag("row_index").over(Window.partitionBy("table_id").orderBy("row_index")) > 1
    gaps = features.withColumn("g", jump).groupBy("table_id").agg(F.coalesce(F.bool_or("g"), F.lit(False)).alias("gap"))
    cases = [("uneven", "DISTORTED"), ("marked", "HAMSHECH")]
    out = F.when(F.lit(False), "")
    for flag, name in reversed(cases) if marks_first else cases:
        out = out.when(F.col(flag), name)
    kind = out.when(F.coalesce("gap", F.lit(False)), "TABLE_GOES_DOWN").otherwise("STANDARD")
    return flags.join(gaps, "table_id", "left").select("table_id", kind.alias("structure"))


def batches(cells: DataFrame, masked: DataFrame, year: Column, titles_dropped: bool = True) -> DataFrame:
    """table_id, row_index, feat and batch: runs of feature rows; the first row that counts is a feature row always.

    titles_dropped: the two title rows of old tables are gone already, so row 0 counts in every year. Else it is row 2
    before 2017.
    """
    first = F.lit(0) if titles_dropped else F.when(year < 2017, 2).otherwise(0)
    rows = cells.select(*ROW, first.alias("_first")).distinct()
    features = G.rows_of_class(masked, "feature").withColumn("_f", F.lit(True))
    feat = F.coalesce("_f", F.lit(False)) | (F.col("row_index") == F.col("_first"))
    order = Window.partitionBy("table_id").orderBy("row_index")
    flagged = rows.join(features, [*ROW], "left").select(*ROW, feat.alias("feat"))
    begins = F.col("feat") & ~F.coalesce(F.lag("feat").over(order), F.lit(False))
    return flagged.withColumn("_b", begins.cast("int")).withColumn("batch", F.sum("_b").over(order)).drop("_b")


def segments(batched: DataFrame) -> DataFrame:
    """Data rows with their batch and their place in its segment."""
    place = F.row_number().over(Window.partitionBy("table_id", "batch").orderBy("row_index")) - 1
    return batched.filter("not feat").select("table_id", "batch", "row_index", place.alias("place"))


def standard(cells: DataFrame, masked: DataFrame) -> DataFrame:
    """Data rows under named columns; a table without feature rows or without data rows is left out here."""
    names = G.unique_names(G.build_headers(cells, G.rows_of_class(masked, "feature"))).withColumnRenamed("name", "column_name")
    data = cells.join(G.rows_of_class(masked, "data"), [*ROW], "left_semi")
    return data.join(names, ["table_id", "col_index"]).select(*ROW, "col_index", "column_name", "cell_value")


def goes_down(cells: DataFrame, masked: DataFrame, year: Column) -> DataFrame:
    """Each batch names its segment, and the segments stand side by side by place."""
    batched = batches(cells, masked, year)
    heads = batched.filter("feat").select(*ROW, "batch")
    names = G.build_headers(cells.join(heads, [*ROW]), heads, ("table_id", "batch"))
    width = Window.partitionBy("table_id")
    names = names.withColumn("col_index", F.col("col_index") + (F.col("batch") - 1) * (F.max("col_index").over(width) + 1))
    names = G.unique_names(names).withColumnRenamed("name", "column_name")
    data = cells.join(segments(batched), [*ROW])
    data = data.withColumn("col_index", F.col("col_index") + (F.col("batch") - 1) * (F.max("col_index").over(width) + 1))
    return data.join(names.drop("batch"), ["table_id", "col_index"]).select("table_id", F.col("place").alias("row_index"), "col_index", "column_name", "cell_value")


def raw(cells: DataFrame) -> DataFrame:
    return cells.select(*ROW, "col_index", F.concat(F.lit("Column_"), F.col("col_index").cast("string")).alias("column_name"), "cell_value")


def normalize(masked: DataFrame, year: Column) -> DataFrame:
    """Every table (cells with their mask) by its structure; a table that its way leaves without rows stays raw.

    Continuation rows go first, after which their table's structure is found again. masked is read several times: give a
    stored table.
    """
    kinds = stage(structure(masked, masked), "structure")
    marked, others = kinds.filter("structure = 'HAMSHECH'"), kinds.filter("structure <> 'HAMSHECH'")
    kept = G.drop_marked_rows(masked.join(marked, "table_id", "left_semi"))
    both = masked.join(others, "table_id", "left_semi").unionByName(kept)
    down = others.unionByName(structure(kept, kept)).filter("structure = 'TABLE_GOES_DOWN'")
    a, b = both.join(down, "table_id", "left_semi"), both.join(down, "table_id", "left_anti")
    named = stage(goes_down(a.drop("mask"), a, year).unionByName(standard(b.drop("mask"), b)), "normalized")
    return named.unionByName(raw(both.drop("mask").join(named.select("table_id").distinct(), "table_id", "left_anti")))

"""Grids in long form: unpivot, pivot, padding, headers, renumbering and row filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions import text as X

KEYS = ("table_id", "row_index", "col_index")


def unpivot(wide: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """keys, col_index and cell_value: one row a cell, nulls kept. A map-only generate."""
    cells = F.posexplode(F.array(*[F.col(c).cast("string") for c in columns])).alias("col_index", "cell_value")
    return wide.select(*keys, cells)


def unpivot_named(wide: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    named = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("cell_value")) for c in columns]))
    return wide.select(*keys, named.alias("x")).select(*keys, "x.*")


def duplicate_cells(cells: DataFrame) -> DataFrame:
    return cells.groupBy(*KEYS).count().filter("count > 1")


def pivot(cells: DataFrame, width: int, keys: Sequence[str] = ("table_id", "row_index"), name: str = "c", strict: bool = True) -> DataFrame:
    """One row a grid row, columns c0.. by position. strict: two values for one cell are an error when the row is read.

    Columns are conditional aggregates of one shuffle, so no job is needed to find them.
    """

    def value(i: int) -> Column:
        here = F.col("col_index") == i
        found = F.max(F.when(here, F.col("cell_value")))
        if strict:
            found = F.when(F.count_if(here) > 1, F.raise_error(F.lit("a cell has two values")).cast("string")).otherwise(found)
        return found.alias(f"{name}{i}")

    return cells.groupBy(*keys).agg(*[value(i) for i in range(width)])


def dense_rows(cells: DataFrame) -> DataFrame:
    """Row numbers 0.. without holes."""
    return cells.withColumn("row_index", F.dense_rank().over(Window.partitionBy("table_id").orderBy("row_index")) - 1)


def skip_title_rows(cells: DataFrame, year: Column, rows: int = 2, before: int = 2017) -> DataFrame:
    """Without the first rows of old tables that have more than those."""
    count = F.max("row_index").over(Window.partitionBy("table_id")) + 1
    return dense_rows(cells.withColumn("_rows", count).filter(~((year < before) & (F.col("_rows") > rows)) | (F.col("row_index") >= rows)).drop("_rows"))


def pad_rows(cells: DataFrame) -> DataFrame:
    """Every row as wide as its table; added cells are null."""
    grid = cells.groupBy("table_id", "row_index").agg(F.collect_list(F.struct("col_index", "cell_value")).alias("x"))
    width = F.max(F.array_max(F.transform("x", lambda c: c["col_index"]))).over(Window.partitionBy("table_id"))
    full = grid.withColumn("width", width).select("table_id", "row_index", F.explode(F.sequence(F.lit(0), "width")).alias("col_index"), F.map_from_entries("x").alias("m"))
    return full.select("table_id", "row_index", "col_index", F.try_element_at("m", F.col("col_index")).alias("cell_value"))


def collapse_runs(rows: DataFrame, keys: Sequence[str], order: str, value: str, sep: str = " ") -> DataFrame:
    """keys and `joined`: values in order, equal neighbours once."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v")))), lambda x: x["v"])
    once = F.filter(F.col("vs"), lambda v, i: (i == 0) | ~v.eqNullSafe(F.get("vs", i - 1)))
    return rows.groupBy(*keys).agg(ordered.alias("vs")).select(*keys, F.concat_ws(sep, once).alias("joined"))


def two_row_names(cells: DataFrame, upper: int = 0, lower: int = 1) -> DataFrame:
    """table_id, col_index and name: the cells of two rows joined, of columns that have the upper."""
    pick = lambda r: F.max(F.when(F.col("row_index") == r, F.col("cell_value")))
    both = cells.filter(F.col("row_index").isin(upper, lower)).groupBy("table_id", "col_index").agg(pick(upper).alias("a"), pick(lower).alias("b"), F.count_if(F.col("row_index") == upper).alias("n"))
    return both.filter("n > 0").select("table_id", "col_index", F.trim(F.concat_ws(" ", F.coalesce("a", F.lit("")), F.coalesce("b", F.lit("")))).alias("name"))


def build_headers(cells: DataFrame, feature_rows: DataFrame, keys: Sequence[str] = ("table_id",), sep: str = " | ") -> DataFrame:
    """keys, col_index and name: the values of feature rows joined downwards; Column_i where all are blank."""
    rows = cells.join(feature_rows.select(*dict.fromkeys([*keys, "row_index"])), [*dict.fromkeys([*keys, "row_index"])])
    value = X.strip(F.col("cell_value"))
    parts = F.array_sort(F.collect_list(F.when(F.coalesce(value, F.lit("")) != "", F.struct("row_index", value.alias("v")))))
    name = F.concat_ws(sep, F.transform(parts, lambda x: x["v"]))
    return rows.groupBy(*keys, "col_index").agg(F.coalesce(F.nullif(name, F.lit("")), F.concat(F.lit("Column_"), F.col("col_index").cast("string"))).alias("name"))


def unique_names(headers: DataFrame, keys: Sequence[str] = ("table_id",)) -> DataFrame:
    """Later columns of one name get __2, __3, ..."""
    n = F.row_number().over(Window.partitionBy(*keys, "name").orderBy("col_index"))
    return headers.withColumn("_n", n).withColumn("name", F.when(F.col("_n") > 1, F.concat("name", F.lit("__"), F.col("_n").cast("string"))).otherwise(F.col("name"))).drop("_n")


def renumber(tables: DataFrame, keys: Sequence[str] = ("chapter", "year"), order: str = "serial") -> DataFrame:
    """Adds new_serial: 1.. inside keys by the old serial."""
    return tables.withColumn("new_serial", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))


def drop_marked_rows(cells: DataFrame, marker: str = X.CONTINUATION) -> DataFrame:
    """Without rows of which a cell contains marker, row numbers closed up."""
    marked = F.coalesce(F.bool_or(F.col("cell_value").contains(marker)).over(Window.partitionBy("table_id", "row_index")), F.lit(False))
    return dense_rows(cells.withColumn("_m", marked).filter(~F.col("_m")).drop("_m"))


def table_flags(cells: DataFrame, marker: str) -> DataFrame:
    """table_id, all_blank and has_marker, for skipping empty tables and charts."""
    blank = F.bool_and(F.coalesce(X.strip(F.col("cell_value")), F.lit("")) == "")
    return cells.groupBy("table_id").agg(blank.alias("all_blank"), F.coalesce(F.bool_or(F.col("cell_value").contains(marker)), F.lit(False)).alias("has_marker"))


def rows_of_class(masked: DataFrame, kind: str) -> DataFrame:
    """table_id and row_index of rows that have the class; `data` means a data point or an undecided cell."""
    wanted = ("data-point", "undecided") if kind == "data" else (kind,)
    return masked.groupBy("table_id", "row_index").agg(F.bool_or(F.col("mask").isin(*wanted)).alias("_has")).filter("_has").drop("_has")


def side_by_side(left: DataFrame, right: DataFrame, offset: int) -> DataFrame:
    """Two segments next to each other by row position; right columns start at offset."""
    return left.unionByName(right.withColumn("col_index", F.col("col_index") + offset))


def missing_pairs(present: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """Combinations of two dimension lists (years, chapters) that present lacks. The combinations are the result's own size;
    Spark broadcasts a list only below its limit."""
    return a.crossJoin(b).join(present.select(*a.columns, *b.columns).distinct(), [*a.columns, *b.columns], "left_anti")


def load_table(cells: DataFrame, table_id: str, width: int, year: int | None = None, chapter: int | None = None) -> DataFrame:
    """One table as a grid: filters that reach the scan, then a pivot, rows in order."""
    wanted = cells.filter(F.col("table_id") == table_id)
    for name, value in (("year", year), ("chapter_id", chapter)):
        wanted = wanted if value is None else wanted.filter(F.col(name) == value)
    return pivot(wanted, width).orderBy("row_index")


def repair_headers(cells: DataFrame, headers: DataFrame, row: int = 1, marker: str = X.TABLE_MARK) -> DataFrame:
    """headers (table_id, header) with a header made from a table's second row where that is plain.

    It is plain if a cell has the marker and the others have one text at most: then the first marked cell and that text, on
    one line. Other tables keep their header.
    """
    value = F.col("cell_value")
    marked = F.coalesce(value.contains(marker), F.lit(False))
    others = F.collect_set(F.when(~marked & (F.coalesce(value, F.lit("")) != ""), value))
    found = cells.filter(F.col("row_index") == row).groupBy("table_id").agg(F.min_by(value, F.when(marked, F.col("col_index"))).alias("_m"), others.alias("_o"))
    line = F.trim(F.translate(F.concat_ws(" ", "_m", F.get("_o", F.lit(0))), "\n\r", "  "))
    fixed = found.filter(F.col("_m").isNotNull() & (F.size("_o") <= 1)).select("table_id", line.alias("_fixed"))
    return headers.join(fixed, "table_id", "left").withColumn("header", F.coalesce("_fixed", "header")).drop("_fixed")


def cell_at(cells: DataFrame, row: int, column: int, pattern: str | None = None) -> DataFrame:
    """table_id, row_index and cell_value of one place in every table; pattern: a LIKE on the value."""
    here = cells.filter((F.col("row_index") == row) & (F.col("col_index") == column))
    return (here if pattern is None else here.filter(F.col("cell_value").like(pattern))).select("table_id", "row_index", "cell_value")

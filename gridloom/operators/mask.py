"""Cell classification by declared rules, and a judge for what they leave open."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions import text as X
from gridloom.model import DATA, FEATURE, NONE, UNDECIDED

ROW = ("table_id", "row_index")


def hard_rules(cells: DataFrame, identity: float = 0.8, consistency: float = 0.3) -> DataFrame:
    """cells with `mask`.

    Missing cells are None and stay so. A row of at least two other cells, a share `identity` of them equal, is a
    feature row. Numbers left over are data points. At last a row goes over to the commoner of the two classes if that
    holds a share `consistency` of its cells. All windows share the row as their partition: one shuffle.
    """
    row = Window.partitionBy(*ROW)
    value = F.when(~X.is_missing(F.col("cell_value")), X.strip(F.col("cell_value")))
    step = cells.withColumn("_v", value)
    step = step.withColumn("_same", F.count("_v").over(Window.partitionBy(*ROW, "_v"))).withColumn("_n", F.count("_v").over(row))
    alike = (F.col("_n") >= 2) & (F.max(F.when(F.col("_v").isNotNull(), F.col("_same"))).over(row) / F.greatest(F.col("_n"), F.lit(1)) >= identity)
    step = step.withColumn("mask", F.when(F.col("_v").isNull(), NONE).when(alike, FEATURE).when(X.is_numeric(F.col("_v"), stripped=True), DATA).otherwise(UNDECIDED))
    features, points = (F.count_if(F.col("mask") == k).over(row) for k in (FEATURE, DATA))
    step = step.withColumn("_f", features).withColumn("_d", points)
    share = lambda n: F.col(n) / F.greatest(F.col("_n"), F.lit(1)) >= consistency
    over = F.when((F.col("_f") > F.col("_d")) & share("_f"), FEATURE).when((F.col("_d") > F.col("_f")) & share("_d"), DATA)
    return step.withColumn("mask", F.when(F.col("mask") == NONE, NONE).otherwise(F.coalesce(over, F.col("mask")))).drop("_v", "_same", "_n", "_f", "_d")


def open_tables(masked: DataFrame) -> DataFrame:
    """table_id of tables that still have an undecided cell."""
    return masked.groupBy("table_id").agg(F.bool_or(F.col("mask") == UNDECIDED).alias("_o")).filter("_o").select("table_id")


def merge_judgement(masked: DataFrame, reply: DataFrame) -> DataFrame:
    """Take a judge's reply (table_id, row_index, col_index, judged) where the rules are undecided.

    A reply counts only if it has exactly the table's cells. Decided cells keep their class; a judge's None on an
    undecided cell leaves it undecided.
    """
    shape = lambda df: df.groupBy("table_id").agg(F.count("*").alias("n"), F.sum(F.xxhash64("row_index", "col_index").cast("decimal(38,0)")).alias("h"))
    fitting = shape(masked.select("table_id", "row_index", "col_index")).join(shape(reply.withColumn("row_index", F.col("row_index").cast(masked.schema["row_index"].dataType))), ["table_id", "n", "h"]).select("table_id")
    known = reply.join(fitting, "table_id", "left_semi")
    said = F.when(F.col("judged").isin(FEATURE, DATA), F.col("judged"))
    return masked.join(known, ["table_id", "row_index", "col_index"], "left").withColumn("mask", F.when(F.col("mask") == UNDECIDED, F.coalesce(said, F.lit(UNDECIDED))).otherwise(F.col("mask"))).drop("judged")


def as_stored(masked: DataFrame) -> DataFrame:
    """The stored mask: is_feature beside the class, which the flag alone would lose."""
    return masked.select("table_id", "row_index", "col_index", (F.col("mask") == FEATURE).alias("is_feature"), F.col("mask").alias("mask_class"))


def from_stored(stored: DataFrame) -> DataFrame:
    return stored.select("table_id", "row_index", "col_index", F.when(F.col("is_feature"), FEATURE).otherwise(DATA).alias("mask"))


def data_cells(cells: DataFrame, stored: DataFrame) -> DataFrame:
    """Cells that are no feature, by an equi join on the cell key."""
    return cells.join(stored.filter(~F.col("is_feature")).select("table_id", "row_index", "col_index"), ["table_id", "row_index", "col_index"])


def align_by_position(cells: DataFrame, masked: DataFrame) -> DataFrame:
    """cells with the mask of the same place, rows counted from the top of each; what one of the two lacks is cut off."""
    place = F.dense_rank().over(Window.partitionBy("table_id").orderBy("row_index"))
    left, right = cells.withColumn("_at", place), masked.select("table_id", "col_index", "mask", place.alias("_at"))
    return left.join(right, ["table_id", "_at", "col_index"]).select(*cells.columns, "mask")


def parse_reply(reply: str | list | None, rows: int, width: int) -> list[list[str]] | None:
    """A judge's grid of classes, from a list or from noisy JSON text; null unless it has exactly the table's shape."""
    if isinstance(reply, str):
        try:
            reply = json.loads(reply[reply.index("[") : reply.rindex("]") + 1])
        except ValueError:
            return None
    fits = isinstance(reply, list) and len(reply) == rows and all(isinstance(r, list) and len(r) == width for r in reply)
    return reply if fits else None


def judge_in_order(masked: DataFrame, judges: dict[str, Callable], small: Sequence[str], large: Sequence[str], limit: int = 30) -> DataFrame:
    """masked, its undecided cells settled by the first judge whose reply has the table's shape, and `judged_by`.

    judges: name -> callable(cells, classes), both lists of rows, that returns a grid or JSON text of one. Tables of more
    than `limit` rows ask `large` in its order, others `small`. A judge that fails, says nothing or answers in another shape
    hands on to the next; where all do, the partial mask stays. Decided cells and missing ones keep their class, and an
    answer other than the two classes leaves a cell undecided. A table is one group.
    """
    settled = {FEATURE, DATA}

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = pdf.assign(judged_by=None).astype({"judged_by": object})
        if not (pdf["mask"] == UNDECIDED).any():
            return out
        rows = {r: i for i, r in enumerate(sorted(pdf["row_index"].unique()))}
        width = int(pdf["col_index"].max()) + 1
        cells, classes = ([[blank] * width for _ in rows] for blank in (None, NONE))
        places = [(rows[r], int(c)) for r, c in zip(pdf["row_index"], pdf["col_index"], strict=True)]
        for (i, j), value, kind in zip(places, pdf["cell_value"], pdf["mask"], strict=True):
            cells[i][j], classes[i][j] = value, kind
        for name in large if len(rows) > limit else small:
            try:
                grid = parse_reply(judges[name](cells, classes), len(rows), width)
            except Exception:  # noqa: BLE001  a judge is the user's code or a service; the next one takes over
                grid = None
            if grid is not None:
                said = [grid[i][j] if kind == UNDECIDED and grid[i][j] in settled else kind for (i, j), kind in zip(places, pdf["mask"], strict=True)]
                return out.assign(mask=said, judged_by=name)
        return out

    schema = ", ".join(f"{n} {k}" for n, k in masked.select("table_id", "row_index", "col_index", "cell_value", "mask").dtypes)
    return masked.select("table_id", "row_index", "col_index", "cell_value", "mask").groupBy("table_id").applyInPandas(run, f"{schema}, judged_by string")

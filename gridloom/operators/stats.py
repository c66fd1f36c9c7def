"""Counts, rates, intervals and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, 100.0 * part / whole).otherwise(0.0)


def wilson(hits: Column, n: Column, z: float = 1.96) -> Column:
    """struct<rate, error, low, high>: Wilson interval of a share, clamped to 0..1, and its standard error."""
    p = hits / F.greatest(n, F.lit(1))
    size = F.greatest(n, F.lit(1)).cast("double")
    middle = (p + z * z / (2 * size)) / (1 + z * z / size)
    half = z * F.sqrt(p * (1 - p) / size + z * z / (4 * size * size)) / (1 + z * z / size)
    return F.struct(p.alias("rate"), F.sqrt(p * (1 - p) / size).alias("error"), F.greatest(middle - half, F.lit(0.0)).alias("low"), F.least(middle + half, F.lit(1.0)).alias("high"))


def infer_types(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys and kind: numeric if all values are, else date, else text; without values text."""
    value = F.col("cell_value")
    all_of = lambda ok: F.coalesce(F.bool_and(F.when(value.isNotNull(), ok)), F.lit(False))
    date = F.try_to_timestamp(value).isNotNull() & value.rlike("[0-9]{1,4}[-/.][0-9]{1,2}[-/.][0-9]{1,4}")
    kind = F.when(all_of(value.try_cast("double").isNotNull()), "numeric").when(all_of(date), "date").otherwise("text")
    return cells.groupBy(*keys).agg(kind.alias("kind"))


def completeness(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    return cells.groupBy(*keys).agg(percent(F.count("cell_value"), F.count("*")).alias("completeness"))


def validate(merged: DataFrame, key: str = "chain_id", least: float = 50.0) -> DataFrame:
    """A row a chain: rows, columns, years, completeness, issues and valid."""
    share = percent(F.count("cell_value"), F.count("*"))
    one = merged.groupBy(key).agg(
        F.countDistinct("meta_year", "row_index").alias("n_rows"), F.countDistinct("column_name").alias("n_columns"), F.countDistinct("meta_year").alias("n_years"),
        share.alias("share"), F.count_if(F.col("meta_year").isNull()).alias("no_year"),
    )
    issues = F.array_compact(
        F.array(F.when(F.col("no_year") > 0, "missing meta_year"), F.when(F.col("n_rows") == 0, "no rows"), F.when(F.col("n_columns") == 0, "no columns"), F.when(F.col("share") < least, "low completeness"))
    )
    return one.select(key, "n_rows", "n_columns", "n_years", F.round("share", 6).alias("completeness"), F.concat_ws("; ", issues).alias("issues"), (F.size(issues) == 0).alias("valid"))


def rollup_counts(df: DataFrame, keys: Sequence[str], **conditions: Column) -> DataFrame:
    """Counts, and counts under conditions, for every prefix of keys down to the grand total."""
    return df.rollup(*keys).agg(F.count("*").alias("n"), *[F.count_if(c).alias(k) for k, c in conditions.items()])


def distribution(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    v = F.col(value)
    return df.groupBy(*keys).agg(F.avg(v).alias("mean"), F.median(v).alias("median"), F.stddev_pop(v).alias("std"), F.min(v).alias("low"), F.max(v).alias("high"))


def normalise_scores(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Adds `scaled`: 0..1 inside keys; a constant group is all 1."""
    from pyspark.sql import Window

    w = Window.partitionBy(*keys)
    low, high = F.min(value).over(w), F.max(value).over(w)
    return df.withColumn("_l", low).withColumn("_h", high).withColumn("scaled", F.when(F.col("_h") > F.col("_l"), (F.col(value) - F.col("_l")) / (F.col("_h") - F.col("_l"))).otherwise(1.0)).drop("_l", "_h")


def summary_by(df: DataFrame, group: str, **distinct: str) -> DataFrame:
    """Rows of each group, and distinct values of the named columns."""
    return df.groupBy(group).agg(*[F.countDistinct(c).alias(n) for n, c in distinct.items()], F.count("*").alias("n"))


def status_by(df: DataFrame, group: str, chain: str, status: str, **states: str) -> DataFrame:
    """Distinct chains of each group, and rows of each named status."""
    return df.groupBy(group).agg(F.countDistinct(chain).alias("chains"), *[F.count_if(F.col(status) == s).alias(n) for n, s in states.items()])


def grouped_counts(df: DataFrame, *keys: str, where: Column | None = None) -> DataFrame:
    """Rows of each combination of keys (or of all, without keys) that meet a condition."""
    kept = df if where is None else df.filter(where)
    return (kept.groupBy(*keys) if keys else kept).agg(F.count("*").alias("n"))


def calls_by(df: DataFrame, group: str, tokens: Column, price: float, ok: Column) -> DataFrame:
    """Calls, tokens, cost, mean tokens and successes in percent of each group."""
    return df.groupBy(group).agg(
        F.count("*").alias("calls"), F.sum(tokens).alias("tokens"), F.round(F.sum(tokens) * price, 6).alias("cost"), F.round(F.avg(tokens), 4).alias("mean_tokens"),
        F.round(percent(F.count_if(ok), F.count("*")), 4).alias("success"),
    )


def listed(df: DataFrame, group: str, value: str) -> DataFrame:
    """A group's values in order."""
    return df.groupBy(group).agg(F.sort_array(F.collect_list(value)).alias("ids"))


def any_contains(df: DataFrame, group: str, column: str, part: str) -> DataFrame:
    """Whether any value of a group contains a text, whatever its case, and the rows."""
    return df.groupBy(group).agg(F.bool_or(F.contains(F.lower(column), F.lit(part.lower()))).alias("flagged"), F.count("*").alias("n"))

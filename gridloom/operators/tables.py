"""Continuation groups, unions, upserts, anti joins and other set-shaped steps on table metadata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.staging import stage


def continuation_groups(tables: DataFrame, order: Sequence[str], is_continuation: Column, within: Sequence[str] = ()) -> DataFrame:
    """Adds `grp`: a continuation belongs to the original before it. within: boundaries that no group crosses.

    Without `within` the order is global: rows are dealt out in ranges of it, and each range starts at the originals of the
    ranges before, whose number is that of Spark's shuffle partitions. Leading continuations have group 0.
    """
    begins = F.when(is_continuation, 0).otherwise(1)
    upto = lambda *keys: Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if within:
        return tables.withColumn("grp", F.sum(begins).over(upto(*within)))
    ranged = stage(tables.withColumn("_begins", begins).repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranges")
    totals = ranged.groupBy("_part").agg(F.sum("_begins").alias("n"))
    before = F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))  # a row a range
    starts = totals.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    return ranged.join(F.broadcast(starts), "_part").withColumn("grp", F.col("_before") + F.sum("_begins").over(upto("_part"))).select(*tables.columns, "grp")


def union_continuations(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of a group one after another: adds new_row, 0.. in part and row order. Title rows of parts are filtered before."""
    return rows.withColumn("new_row", F.row_number().over(Window.partitionBy(*key).orderBy(*order)) - 1)


def same_name_groups(tables: DataFrame, name: str, ident: str) -> DataFrame:
    """name, first identifier and how many tables carry the name."""
    return tables.groupBy(name).agg(F.min(ident).alias("first_id"), F.count("*").alias("n"))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key; the rest of the row travels as one struct through a partial aggregate, not a window."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    return df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_m")).select(*keys, "_m.*").select(*df.columns)


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New rows win; others stay."""
    values = [c for c in old.columns if c not in keys]
    a = old.select(*keys, F.struct(*values).alias("_old"))
    b = new.select(*keys, F.struct(*values).alias("_new"))
    both = a.join(b, list(keys), "full_outer").select(*keys, F.coalesce("_new", "_old").alias("_v"))
    return both.select(*keys, "_v.*")


def seed_pending(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Keys of source that target lacks, once, as pending."""
    return source.select(key).distinct().join(target.select(key).distinct(), key, "left_anti").withColumn("status", F.lit("pending"))


def keep_unflagged(rows: DataFrame, flags: DataFrame, key: str, flag: str) -> DataFrame:
    """Rows whose flag is NO or absent."""
    return rows.join(flags.select(key, flag), key, "left").filter(F.coalesce(flag, F.lit("NO")) == "NO").drop(flag)


def look_back(rows: DataFrame, keys: Sequence[str], order: str, value: Column, reach: int = 3) -> Column:
    """The latest non-null value among the `reach` rows before."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-reach, -1)
    return F.last(value, ignorenulls=True).over(w)


def hash_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows by a hash of key and seed: the same rows whatever the partitioning. A sampling operator: n is its feature."""
    rank = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))).cast("binary"))
    return df.withColumn("_r", rank).orderBy("_r", key).limit(n).drop("_r")


def assign_in_turn(sample: DataFrame, people: Sequence[str], key: str, seed: int = 42) -> DataFrame:
    """Deal sampled rows out to people in turn. The sample is small by construction."""
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))).cast("binary")), key)) - 1
    return sample.withColumn("slot", rank).withColumn("person", F.get(F.array(*[F.lit(p) for p in people]), F.col("slot") % len(people)))


def sample_or_repeat(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows by a hash, with `slot`; where there are fewer than n, rows are taken again in the same order."""
    first = hash_sample(df, key, n, seed)
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))).cast("binary")), key)) - 1  # n rows at most
    ranked = first.withColumn("_r", rank).withColumn("_n", F.count("*").over(Window.partitionBy(F.lit(0))))
    return ranked.withColumn("slot", F.explode(F.sequence(F.col("_r"), F.lit(n - 1), F.col("_n").cast("int")))).drop("_r", "_n")


def with_keys(df: DataFrame, key: str, wanted: Sequence) -> DataFrame:
    """Rows of the wanted keys."""
    return df.filter(F.col(key).isin(*wanted))


def without_keys(df: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among those of `gone`: entries of continuations leave a dictionary."""
    return df.join(gone.select(key).distinct(), key, "left_anti")


def with_text(df: DataFrame, column: str, parts: Sequence[str]) -> DataFrame:
    """Rows whose column contains one of the parts."""
    return df.filter(F.exists(F.array(*[F.lit(p) for p in parts]), lambda x: F.col(column).contains(x)))


def with_label(rows: DataFrame, flags: DataFrame, key: str, flag: str, wanted: str) -> DataFrame:
    """Rows that carry the wanted flag."""
    return rows.join(flags.filter(F.col(flag) == wanted).select(key).distinct(), key, "left_semi")


def distinct_keys(df: DataFrame, **columns: Column) -> DataFrame:
    return df.select(*[c.alias(n) for n, c in columns.items()]).distinct()


def first_by(df: DataFrame, columns: Sequence[str], order: Sequence[Column | str], n: int) -> DataFrame:
    """The first n rows in an order: a report, n is its feature."""
    return df.select(*columns).orderBy(*order).limit(n)

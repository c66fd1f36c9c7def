"""What the operators share: the word rule, batches of bounded size, and ranges of a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.staging import discard
from gridloom.staging import stage as materialize

__all__ = ["BATCH_BYTES", "MAX_PARTS", "WORD", "by_counted_key", "discard", "map_batches", "materialize", "part_of", "range_bounds", "spare"]

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Most parts that `range_bounds` makes; beyond it the parts grow instead, and windows over them spill.
MAX_PARTS = 16_384

#: Bytes of an Arrow batch. A batch lies in the executor and in its Python worker, some of it twice.
BATCH_BYTES = 4 << 20


def map_batches(df: DataFrame, run, schema: str) -> DataFrame:
    """mapInArrow with batches of bounded bytes, so very long texts do not add up in memory.

    The bound is a session setting that Spark reads when the plan runs, so it is lowered for the session, never raised.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark = df.sparkSession
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name)) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def spare(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of df has, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"{name}_"
        taken.add(name.lower())
        out.append(name)
    return out


#: Most keys that `by_counted_key` broadcasts.
FREQUENT = 50_000


def by_counted_key(rows: DataFrame, counts: DataFrame, keys: list[str], total: int) -> DataFrame:
    """Inner join on keys, where counts has one row a key and `many`, the number of its rows among the `total` of rows.

    Keys with over total / FREQUENT rows (1000 at least) are broadcast, and there can be at most FREQUENT of them; the
    others are joined by a shuffle, in which no key is large. So no task gets a key that holds much of the table.
    """
    limit = max(1_000, total // FREQUENT)
    frequent = F.broadcast(counts.filter(F.col("many") > limit))
    rest = rows.join(frequent.select(*keys), keys, "left_anti").join(counts.filter(F.col("many") <= limit), keys)
    return rows.join(frequent, keys).unionByName(rest)


def range_bounds(df: DataFrame, key: str, rows_per_part: int) -> list[int]:
    """Sorted cut points of an integer key, so that parts hold about rows_per_part rows.

    Only the key column is read. The list has at most MAX_PARTS entries whatever the input's size.
    """
    n = df.select(key).count()
    parts = min(MAX_PARTS, n // max(1, rows_per_part))
    if parts < 2:
        return []
    probs = [i / parts for i in range(1, parts)]
    got = df.agg(F.percentile_approx(F.col(key), probs, max(10_000, 4 * parts)).alias("b")).first()["b"] or []
    return sorted({int(x) for x in got})


def part_of(key: Column, bounds: list[int]) -> Column:
    """Number of cut points at or below key (null: 0), by two short scans instead of one long one."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))

    def below(cuts: Column) -> Column:
        return F.size(F.filter(cuts, lambda b: b <= key))

    literal = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    if len(bounds) <= 32:
        return below(literal(bounds))
    blocks = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    block = below(literal([b[0] for b in blocks])) - 1
    cuts = F.get(F.array(*[literal(b) for b in blocks]), F.greatest(block, F.lit(0)))
    return F.when(block < 0, F.lit(0)).otherwise(block * step + below(cuts))

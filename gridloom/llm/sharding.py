"""Contiguous shards of nearly equal bytes.

Documents are ordered by doc_id. Parts of that order get their totals, whose running sums come to the driver (one row
a part, at most MAX_PARTS), and a window inside each part adds the rest, so every document knows the bytes before it.
A document goes to the shard in whose equal share of the total its middle lies. DataFrame expressions only.

Defined results. Null and empty text: no bytes, so the size is the overhead alone. Equal doc_ids: ordered by checksum
and size; equal rows take neighbouring slots. Null doc_ids come first. One document larger than a share fills its shard
and the next ones may be empty. Equal texts form no group under this law: copies go where their doc_ids lie, so that
sizes stay equal whatever group of copies there is. Empty table: empty result. Extra columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import MAX_PARTS, materialize, part_of, range_bounds


def running_totals(placed: DataFrame, by: list[str], sums: dict[str, str]) -> DataFrame:
    """Of each part (and category): what lies before it in part order. At most MAX_PARTS rows a category."""
    rows = placed.groupBy("part", *by).agg(*[F.sum(c).cast("long").alias(n) for n, c in sums.items()], F.count("*").alias("rows")).collect()
    names = [*sums, "rows"]
    before: dict[tuple, list[int]] = {}
    out = []
    for r in sorted(rows, key=lambda r: r["part"]):
        so_far = before.setdefault(tuple(r[c] for c in by), [0] * len(names))
        out.append((r["part"], *[r[c] for c in by], *so_far))
        for i, n in enumerate(names):
            so_far[i] += r[n] or 0
    kinds = dict(placed.dtypes)
    schema = ", ".join([f"part {kinds['part']}", *[f"{c} {kinds[c]}" for c in by], *[f"{n}_before long" for n in names]])
    return F.broadcast(placed.sparkSession.createDataFrame(out, schema))


def shard_by_bytes(docs: DataFrame, shards: int = 40, overhead: int = 16, rows_per_part: int = 4_000) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    sizes = materialize(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + overhead).cast("long").alias("size"), F.crc32(text.cast("binary")).cast("long").alias("text_crc32")), "sizes"
    )
    placed = sizes.withColumn("part", part_of(F.col("doc_id"), range_bounds(sizes, "doc_id", rows_per_part)))
    total = sizes.agg(F.sum("size")).first()[0] or 1
    inside = Window.partitionBy("part").orderBy(F.asc_nulls_first("doc_id"), "text_crc32", "size")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = (
        placed.withColumn("upto", F.sum("size").over(upto))
        .withColumn("row", F.row_number().over(inside))
        .join(running_totals(placed, [], {"size": "size"}), "part")
        .withColumn("row", F.col("rows_before") + F.col("row") - 1)
        .withColumn("twice_middle", 2 * (F.col("size_before") + F.col("upto")) - F.col("size"))
    )
    # Decimal arithmetic: bytes times shards may pass 63 bits.
    shard = F.least(F.floor(F.col("twice_middle").cast("decimal(38,0)") * shards / F.lit(2 * total).cast("decimal(38,0)")).cast("int"), F.lit(shards - 1))
    dealt = materialize(at.select("doc_id", "size", "text_crc32", shard.alias("shard"), "row"), "shards")
    first = F.broadcast(dealt.groupBy("shard").agg(F.min("row").alias("first")))  # `shards` rows at most
    return dealt.join(first, "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("row") - F.col("first")).alias("slot"))

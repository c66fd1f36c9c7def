"""Packing into batches of similar length.

The histogram of lengths is global: one row a length, summed in Spark. Dynamic programming over it chooses the bucket
boundaries with the least padding for a number of buckets; a hull of lines gives each step its best predecessor, so the
work grows with lengths times buckets. Inside a bucket every document is padded to the boundary, and as many rows as the
token budget allows form a batch. Row numbers come from totals of parts of the doc_id order and a window inside a part,
so a bucket that holds most rows is never gathered.

A length is any integer column: tokens of the corpus pipeline, which counts them with the unigram tokenizer, or words plus
one (`with_lengths`), which cost less. The budget is in the same unit.

Boundaries are the best of all lengths, however many there are: d distinct lengths need d * d / 2 words at least, so the
histogram grows with the square root of the corpus. Over `max_lengths` rows of it come to the driver a partition at a
time, with the same result. Batches always hold whole documents.

Defined results. Null, empty and blank texts have no words and length 1, for an end mark. A very long text, longer than the
budget, is a batch alone. Equal doc_ids are ordered by length, null ones come first; repeated rows get neighbouring places.
Fewer lengths than buckets: one bucket a length. Empty table: empty result. Columns not in `keep` are dropped; kept ones
must not have a name of the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import materialize, part_of, range_bounds
from gridloom.llm.sharding import running_totals

SPACE = r"[\x20\x09-\x0D]+"


def never_least(a: tuple, b: tuple, c: tuple) -> bool:
    """Whether b, between lines of larger and smaller slope, lies nowhere below both."""
    return (c[1] - a[1]) * (a[0] - b[0]) <= (b[1] - a[1]) * (a[0] - c[0])


def best_buckets(histogram: dict[int, int], buckets: int) -> list[int]:
    """Boundaries, the last the greatest length, that minimise padding when each length is padded to the next boundary.

    Padding of lengths i..j-1 padded to the length of j-1 is L[j-1] * (N[j] - N[i]) - (S[j] - S[i]) with running counts N
    and sums S. For fixed j the choice of i is the least of lines in L[j-1] with slopes -N[i], which fall as i grows.
    """
    lengths = sorted(k for k, n in histogram.items() if n)
    if not lengths:
        return []
    n, s = [0], [0]
    for k in lengths:
        n.append(n[-1] + histogram[k])
        s.append(s[-1] + histogram[k] * k)
    m = len(lengths)
    cost = [0] + [None] * m  # of the first j lengths with the buckets so far; None: cannot be
    back: list[list[int]] = []
    for _ in range(min(buckets, m)):
        hull: list[tuple[int, int, int]] = []  # slope, value at 0, i
        at, now, came = 0, [None] * (m + 1), [0] * (m + 1)
        for j in range(1, m + 1):
            i = j - 1
            if cost[i] is not None:
                line = (-n[i], cost[i] + s[i], i)
                while len(hull) - at >= 2 and never_least(hull[-2], hull[-1], line):
                    hull.pop()
                hull.append(line)
            if not hull:
                continue
            x = lengths[j - 1]
            while at + 1 < len(hull) and hull[at + 1][0] * x + hull[at + 1][1] <= hull[at][0] * x + hull[at][1]:
                at += 1
            slope, value, i = hull[at]
            now[j], came[j] = x * n[j] - s[j] + slope * x + value, i
        if cost[m] is not None and now[m] is not None and now[m] >= cost[m]:
            break  # another bucket saves nothing
        back.append(came)
        cost = now
    out, j = [], m
    for came in reversed(back):
        out.append(lengths[j - 1])
        j = came[j]
    return out[::-1]


def length_histogram(rows: DataFrame, max_lengths: int) -> dict[int, int]:
    """Rows of each length; at most max_lengths of them are sent to the driver in one go, or a partition's."""
    counts = materialize(rows.groupBy("length").agg(F.count("*").alias("n")), "histogram")
    return {r["length"]: r["n"] for r in (counts.collect() if counts.count() <= max_lengths else counts.toLocalIterator())}


def pack(
    docs: DataFrame, length: str = "n_words", buckets: int = 8, budget: int = 65_536, max_lengths: int = 50_000, rows_per_part: int = 4_000, keep: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id, keep, length, bucket, width, batch, slot and padding of every row of docs; `batch` is unique over all buckets."""
    rows = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(length).cast("long").alias("length"), *keep), "lengths")
    widths = best_buckets(length_histogram(rows, max_lengths), buckets) or [1]
    each = [max(1, budget // w) for w in widths]
    edges = F.array(*[F.lit(w).cast("long") for w in widths])
    part = part_of(F.col("doc_id"), range_bounds(rows, "doc_id", rows_per_part))
    placed = rows.withColumn("part", part).withColumn("bucket", F.size(F.filter(edges, lambda w: w < F.col("length"))))
    inside = Window.partitionBy("part", "bucket").orderBy(F.asc_nulls_first("doc_id"), "length")
    row = placed.withColumn("row", F.row_number().over(inside)).join(running_totals(placed, ["bucket"], {}), ["part", "bucket"])
    counts = {r["bucket"]: r["n"] for r in placed.groupBy("bucket").agg(F.count("*").alias("n")).collect()}
    first, starts = 0, []
    for b, size in enumerate(each):
        starts.append(first)
        first += -(-counts.get(b, 0) // size)
    pick = lambda xs: F.get(F.array(*[F.lit(x).cast("long") for x in xs]), F.col("bucket"))
    return (
        row.withColumn("row", F.col("rows_before") + F.col("row") - 1)
        .withColumn("width", pick(widths))
        .select(
            "doc_id",
            *keep,
            "length",
            "bucket",
            "width",
            (pick(starts) + F.floor(F.col("row") / pick(each))).cast("long").alias("batch"),
            (F.col("row") % pick(each)).cast("long").alias("slot"),
            (F.col("width") - F.col("length")).alias("padding"),
        )
    )


def with_lengths(docs: DataFrame, name: str = "n_words") -> DataFrame:
    """doc_id and the number of words plus one."""
    words = F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), SPACE), ""))
    return docs.select("doc_id", (words + 1).cast("long").alias(name))

"""SimHash near-duplicates: 64-bit fingerprints, pigeonhole blocks, verified links, connected components.

Two fingerprints at most two bits apart agree in two of four 16-bit quarters at least, so distinct fingerprints are
joined on the six pairs of quarters and the Hamming distance is verified. Blocks with more than `max_block` distinct
fingerprints are not joined with themselves, which would grow with the square. Their fingerprints emit themselves
and their 64 one-bit neighbours instead: two are linked exactly if they meet at a value between them, and at most 65
distinct fingerprints can meet at one value. Both ways find every link, so the result does not depend on max_block.

Equal fingerprints are one node; its documents are never paired. Components are found by alternating large and small
stars, each round a table in the shared folder.

Defined results. Null, empty and blank text: no words, fingerprint zero, linked like any other. Very long texts: whole, their
shingles hashed in blocks. Fewer words than a shingle: the whole sequence is the one shingle. Repeated rows: one result each. A row without doc_id gets its
fingerprint, and the smallest known id of its component or null. Empty table: empty result. Extra columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations, count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import discard, map_batches, materialize

SEED = 42
DISTANCE = 2
QUARTERS = (48, 32, 16, 0)
#: Shingles hashed at a time, so that a very long text needs bounded memory for its bits.
CHUNK = 32_768


def text_fingerprint(text: bytes, shingle: int = 3) -> int:
    """Unsigned 64-bit fingerprint; a bit is 1 if it is set in over half of the shingles' hashes, repeats included."""
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        return digest(b" ".join(words), SEED)
    line = b" ".join(words)
    ends = list(accumulate((len(w) + 1 for w in words), initial=0))
    n = len(words) - shingle + 1
    counts = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        to = min(n, at + CHUNK)
        hashes = [digest(line[a : b - 1], SEED) for a, b in zip(ends[at:to], ends[at + shingle : to + shingle], strict=True)]
        bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def _fingerprint_batches(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            found = np.fromiter((text_fingerprint(t.as_py() or b"", shingle) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], pa.array(found.view(np.int64))], names=["doc_id", *batch.schema.names[2:], "fp"])

    return run


def fingerprints(docs: DataFrame, shingle: int = 3, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, keep (longs) and fp, the fingerprint as a signed long. Each text is read once, where it lies."""
    schema = "".join(f"{x} long, " for x in ("doc_id", *keep)) + "fp long"
    return map_batches(docs.select(F.col("doc_id").cast("long"), "text", *keep), _fingerprint_batches(shingle), schema)


def links(distinct: DataFrame, max_block: int = 64) -> DataFrame:
    """All pairs (u, v), u > v, of distinct fingerprints that are linked, or enough of them in large blocks to connect the same ones."""
    part = lambda shift: F.shiftrightunsigned("fp", shift).bitwiseAND(0xFFFF)
    keys = [F.lit(i << 32).bitwiseOR(F.shiftleft(part(a), 16)).bitwiseOR(part(b)) for i, (a, b) in enumerate(combinations(QUARTERS, 2))]
    blocks = distinct.select("fp", F.explode(F.array(*keys)).alias("block"))
    sizes = blocks.groupBy("block").agg(F.count("*").alias("n")).filter("n > 1")
    shared = materialize(blocks.join(sizes, "block"), "simhash-blocks")
    few, many = shared.filter(F.col("n") <= max_block), shared.filter(F.col("n") > max_block)
    a, b = few.select("block", F.col("fp").alias("u")), few.select("block", F.col("fp").alias("v"))
    near = (F.col("u") > F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= DISTANCE)
    paired = a.join(b, (a["block"] == b["block"]) & near).select("u", "v")
    flips = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(64)])
    met = many.select("fp").distinct().select("fp", F.explode(flips).alias("at")).groupBy("at").agg(F.collect_set("fp").alias("fps")).filter("size(fps) > 1")
    star = met.select(F.array_min("fps").alias("v"), F.explode("fps").alias("u")).filter("u <> v").select("u", "v")
    return paired.union(star).distinct()


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def connected(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """(node, root) of every node with an edge (u, v); root is the smallest node of the component.

    Alternating stars keep connectivity and converge in a number of rounds that grows with the logarithm of the
    component's size; they run until a round changes nothing. With `rounds`, stars that still change after so many are an
    error. A node's neighbours are reduced to a minimum before the shuffle, and never listed.
    """
    now = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "stars")
    before = None
    for done in count():
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        if rounds is not None and done >= rounds:
            raise RuntimeError(f"components are not stable after {rounds} rounds")
        before = state
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v"))))
        small = large.join(least, "u").select(pairs.alias("e")).select("e.u", "e.v").filter("u <> v").distinct()
        last, now = now, materialize(small, "stars")
        discard(last)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def grouped(docs: DataFrame, shingle: int, max_block: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, keep, fp, root and component_id of every document; root names the component even where no doc_id is known."""
    prints = materialize(fingerprints(docs, shingle, keep), "simhash")
    classes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-classes")
    roots = connected(links(classes.select("fp"), max_block)).withColumnRenamed("node", "fp")
    rooted = classes.join(roots, "fp", "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    low = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = rooted.join(low, "root").select("fp", "root", "component_id")
    return prints.join(named, "fp").select("doc_id", *keep, "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_block: int = 64) -> DataFrame:
    """doc_id, fp (signed long) and component_id of every document."""
    return grouped(docs, shingle, max_block).select("doc_id", "fp", "component_id")


def hexed(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def keep_first(docs: DataFrame, shingle: int = 3, max_block: int = 64) -> DataFrame:
    """One row of docs a group: of the smallest doc_id, rows without doc_id last; of equal ones, of the least text hash.

    A row is known by doc_id and two hashes of its text. Copies in both are one row, the first by a hash of all columns;
    each task drops its own before the one shuffle of the texts.
    """
    key = ("_keep_absent", "_keep_known", "_keep_hash", "_keep_more")
    absent, known = F.col("doc_id").isNull().cast("long"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0))
    keyed = docs.select("*", absent.alias("_keep_absent"), known.alias("_keep_known"), F.xxhash64("text").alias("_keep_hash"), F.hash("text").cast("long").alias("_keep_more"))
    first = grouped(keyed, shingle, max_block, key).groupBy("root").agg(F.min(F.struct(*key)).alias("k")).select("k.*")
    hashed = [name for name, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    copies = Window.partitionBy(*key).orderBy(F.xxhash64(*hashed))
    single = keyed.withColumn("_keep_copy", F.row_number().over(copies)).filter("_keep_copy = 1").drop("_keep_copy")
    return single.join(first, list(key), "left_semi").select(*docs.columns)

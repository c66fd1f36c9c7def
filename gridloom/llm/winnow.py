"""Document fingerprints by winnowing. DataFrame expressions only.

A text becomes hashes of its k-grams of words; every window of w grams keeps its least hash, the rightmost of equal
ones, with its position. Two texts that share w + k - 1 words in a row therefore share a fingerprint entry, and no
shared run under k words alone makes one. Likeness is the Jaccard similarity of the kept hashes.

A gram is kept exactly if some window has it as its rightmost least: going left over hashes not smaller and right over
hashes greater, the run that it rules is at least a window long. This needs a few comparisons a gram and no list of
windows. Words of over 64 characters count as pieces of 16, so texts without spaces have more than one gram.

Neighbours in doc_id order meet by ranges of doc_id: each range also gets the first row of the range below, so one
shuffle of the texts and a window inside each range are enough.

Defined results. Null, empty and blank text: no gram, empty fingerprint; two empty fingerprints have likeness 1, an empty
and another 0. Very long texts: whole, one array of hashes a text. Fewer words than k: one gram of all. Fewer grams than a window: one window. Equal doc_ids: in order of
text. Null doc_id: as the least. A document alone is its own next. Empty table: empty result. Extra columns are dropped.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import part_of, range_bounds

SPACE = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class WinnowParams:
    #: Words in a gram, and grams in a window: shared runs of gram + window - 1 words are always found.
    gram: int = 5
    window: int = 8
    rows_per_part: int = 500


def add_fingerprint(df: DataFrame, text: str, out: str, params: WinnowParams) -> DataFrame:
    """Adds `out`, an array of (hash, position) in position order."""
    k, w = params.gram, params.window
    words = F.array_remove(F.split(F.col(text), SPACE), "")
    pieces = F.flatten(F.transform("_words", lambda x: F.when(F.length(x) > 64, F.regexp_extract_all(x, F.lit("(?s)(.{1,16})"), F.lit(1))).otherwise(F.array(x))))
    df = df.withColumn("_words", words).withColumn("_hash", F.transform(F.when(F.exists("_words", lambda x: F.length(x) > 64), pieces).otherwise(F.col("_words")), lambda x: F.xxhash64(x)))
    n = F.size("_hash")
    grams = F.transform(F.slice("_hash", 1, F.greatest(n - (k - 1), F.lit(0))), lambda h, i: F.xxhash64(h, *[F.get("_hash", i + j) for j in range(1, k)]))
    df = df.drop("_words").withColumn("_gram", F.when(n >= k, grams).when(n > 0, F.array(F.xxhash64("_hash"))).otherwise(F.array().cast("array<bigint>")))
    gram = lambda i: F.get("_gram", i)

    def run(here: Column, i: Column, step: int, far: int = 1) -> Column:
        """How many grams beside i, up to a window's, i rules on one side."""
        ok = gram(i + step * far) >= here if step < 0 else gram(i + step * far) > here
        return F.when(ok, 1 + run(here, i, step, far + 1) if far < w - 1 else F.lit(1)).otherwise(0) if w > 1 else F.lit(0)

    need = F.least(F.lit(w), F.size("_gram")) - 1
    df = df.drop("_hash").withColumn("_need", need)
    kept = F.filter(F.transform("_gram", lambda g, i: F.struct(g.alias("hash"), i.alias("at"))), lambda x: run(x["hash"], x["at"], -1) + run(x["hash"], x["at"], 1) >= F.col("_need"))
    return df.withColumn(out, F.transform(kept, lambda x: F.struct(x["hash"].bitwiseAND(0xFFFFFFFF).alias("hash"), x["at"].alias("at")))).drop("_gram", "_need")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of distinct hashes."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, 1.0).otherwise(both / F.greatest(either, F.lit(1)))


def hash_set(prints: str) -> Column:
    return F.array_distinct(F.transform(prints, lambda x: x["hash"]))


def as_string(prints: str) -> Column:
    return F.array_join(F.transform(prints, lambda x: F.lower(F.lpad(F.hex(x["hash"]), 8, "0"))), " ")


def with_next(docs: DataFrame, params: WinnowParams) -> DataFrame:
    """doc_id, text, prints, and the text and prints of the next document by descending doc_id; after the last, the first."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), key.alias("key"))
    bounds = range_bounds(docs.select(key.alias("key")), "key", params.rows_per_part)
    placed = rows.withColumn("part", part_of(F.col("key"), bounds))
    # One row a range, at most MAX_PARTS: its greatest key, and the range above that needs this row behind its own.
    up = Window.orderBy(F.desc("part"))
    tops = placed.groupBy("part").agg(F.max("key").alias("key"))
    tops = tops.select("key", F.coalesce(F.lag("part").over(up), F.min("part").over(Window.partitionBy(F.lit(0)))).alias("also"))
    homes = F.filter(F.array(F.struct("part", F.lit(False).alias("border")), F.struct(F.col("also").alias("part"), F.lit(True).alias("border"))), lambda x: x["part"].isNotNull())
    dealt = placed.join(F.broadcast(tops), "key", "left").select("doc_id", "text", "key", F.explode(homes).alias("home")).select("doc_id", "text", "key", "home.part", "home.border")
    printed = add_fingerprint(dealt.repartition("part"), "text", "prints", params)
    order = Window.partitionBy("part").orderBy("border", F.desc("key"), "text")
    follow = F.lead(F.struct("text", "prints")).over(order)
    return printed.withColumn("next", follow).filter("not border").select("doc_id", "text", "prints", F.col("next.text").alias("next_text"), F.col("next.prints").alias("next_prints"))


def fingerprint_documents(docs: DataFrame, params: WinnowParams = WinnowParams()) -> DataFrame:
    """Fingerprints of every text, its edited text and their likeness; `positions` are the gram numbers of the fingerprint."""
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    both = add_fingerprint(with_next(docs, params).withColumn("edited", edited), "edited", "edited_prints", params)
    return both.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_string("prints").alias("fingerprint"),
        as_string("edited_prints").alias("edited_fingerprint"),
        likeness(hash_set("prints"), hash_set("edited_prints")).alias("near_edited"),
        likeness(hash_set("prints"), hash_set("next_prints")).alias("near_next"),
        F.transform("prints", lambda x: x["at"]).alias("positions"),
    )

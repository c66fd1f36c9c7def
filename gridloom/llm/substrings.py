"""Substring dedup: words covered by a window that also starts earlier in the corpus are removed.

Equal windows must meet without every document being streamed through every shard. Each window is named by the least
hash of its six-word grams. Windows in a row that take one gram's hash form a segment, and equal windows have equal names. Names
that occur once in the corpus cannot repeat; their segments are dropped after a count that is summed before the shuffle.
The rest go to shards by name, so a shard sees all windows that could equal its own, and shards stay of one size.

Equal segments are one before they travel: their first place is a minimum taken on both sides of the shuffle, and every
other occurrence is removed whole. A shard builds an FM-index of its distinct segments, each standing for its first
place: the Burrows-Wheeler transform of their suffixes, sorted to the window's depth, in a wavelet matrix of packed bits,
bit vectors with ranks for where groups of rows begin, and a place only for groups that repeat. Segments are streamed from
right to left in step; backward search gives the row range of the current match, which is cut back by one word once it
is a window long, so every position has its matching statistic up to that length. Where it reaches a window, the first
occurrence in the range decides, and positions in a row are reported as an interval.

A name with more than `max_group` distinct segments (contexts of a passage that very many documents share) does not go to
one shard: its windows are hashed whole (128 bits), and the first of each is again a minimum. Documents with equal
texts (two independent hashes, 128 bits) are settled by their whole text. All ways give the same rule's result. Joins on
keys that hold much of the table broadcast those keys, of which there are at most 50,000 whatever the input.

Defined results. Null, empty, blank and short texts: nothing removed. A row without doc_id is kept whole and counts as no
source. Rows with one doc_id are one document: only an earlier start counts among them, so equal rows remove nothing
from each other. Very long texts: a batch of texts is held in memory, never more. Empty table: empty result. Extra columns
are dropped; `remove_repeats` keeps them, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import by_counted_key, discard, map_batches, materialize, spare

TOGETHER = 400_000


@dataclass(frozen=True)
class RepeatParams:
    window: int = 20
    gram: int = 6
    #: Distinct segments of one name that one shard may hold: with 26 words each, about 0.3 million words of a task's memory.
    max_group: int = 10_000
    words_per_shard: int = 200_000


# ---------------------------------------------------------------- segments


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def segments(texts: list[list[bytes]], window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, first window's start, windows and name of each segment."""
    sizes = np.array([len(t) for t in texts], np.int64)
    n = int(sizes.sum())
    none = np.empty(0, np.int64)
    if n < window:
        return none, none, none, none
    words = np.fromiter(map(xxhash.xxh64_intdigest, chain.from_iterable(texts)), np.uint64, n)
    grams = np.zeros(n - gram + 1, np.uint64)
    for j in range(gram):
        grams = _mix(grams + words[j : n - gram + 1 + j])
    # Leftmost least gram of every window, by doubling. Windows of one place differ, so a segment has no equal windows.
    reach, low, place = 1, grams, np.arange(len(grams), dtype=np.int32)
    want = window - gram + 1
    while reach < want:
        step = min(reach, want - reach)
        left, right = slice(0, len(low) - step), slice(step, None)
        take = low[left] <= low[right]
        low, place = np.where(take, low[left], low[right]), np.where(take, place[left], place[right])
        reach += step
    begins = np.cumsum(sizes) - sizes
    text = np.repeat(np.arange(len(texts)), sizes)
    at = np.flatnonzero(text[: n - window + 1] == text[window - 1 :])
    if not len(at):
        return none, none, none, none
    name, place = low[at], place[at]
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]) | np.concatenate([[True], text[at[1:]] != text[at[:-1]]]))
    count = np.diff(np.append(first, len(at)))
    start = at[first]
    return text[start], start - begins[text[start]], count, name[first].view(np.int64)


def _groups(sizes: list[int]) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(sizes):
        to, total = at, 0
        while to < len(sizes) and (to == at or total + sizes[to] <= TOGETHER):
            total += sizes[to]
            to += 1
        yield at, to
        at = to


def _name_segments(params: RepeatParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            sizes = [len(t.as_buffer()) // 6 for t in texts]
            for at, to in _groups(sizes):
                which, start, count, name = segments([texts[i].as_py().split() for i in range(at, to)], params.window, params.gram)
                take = pa.array(which + at)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take), pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32)), pa.array(name)], names=["doc_id", "th", "start", "n", "name"]
                )

    return run


# ---------------------------------------------------------------- FM-index


class BitVector:
    """Packed bits with the number of ones before each block of 64."""

    def __init__(self, flags: np.ndarray):
        packed = np.packbits(flags, bitorder="little")
        self.blocks = np.concatenate([packed, np.zeros(-len(packed) % 8 + 8, np.uint8)]).view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.blocks), dtype=np.int64)[:-1]]).astype(np.int32)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before at."""
        block = at >> 6
        inside = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.blocks[block] & inside).astype(np.int64)

    def select(self, k: np.ndarray) -> np.ndarray:
        """Where one number k, from 0 on, stands."""
        block = np.searchsorted(self.before, k, side="right") - 1
        left, bits, at = k - self.before[block], self.blocks[block], block << 6
        for width in (32, 16, 8, 4, 2, 1):
            low = bits & np.uint64((1 << width) - 1)
            ones = np.bitwise_count(low)
            above = left >= ones
            left = left - np.where(above, ones, 0)
            bits = np.where(above, bits >> np.uint64(width), low)
            at = at + np.where(above, width, 0)
        return at


class WaveletMatrix:
    """Ranks of symbols in a sequence, a bit vector for each bit of the alphabet."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels = max(1, int(symbols - 1).bit_length())
        self.planes, self.zeros = [], []
        now = sequence
        for level in reversed(range(self.levels)):
            bit = (now >> level) & 1 == 1
            self.planes.append(BitVector(bit))
            zeros = now[~bit]
            self.zeros.append(len(zeros))
            now = np.concatenate([zeros, now[bit]])

    def rank(self, symbol: np.ndarray, at: np.ndarray, first: np.ndarray) -> np.ndarray:
        """How often each symbol stands before at. first: where its run begins in the last plane's order."""
        for i, level in enumerate(reversed(range(self.levels))):
            ones = self.planes[i].rank(at)
            at = np.where((symbol >> level) & 1 == 1, self.zeros[i] + ones, at - ones)
        return at - first

    def firsts(self, symbols: int) -> np.ndarray:
        """Where each symbol's run begins after the last plane."""
        symbol = np.arange(symbols)
        return self.rank(symbol, np.zeros(symbols, np.int64), np.zeros(symbols, np.int64))


class FmIndex:
    """Of a text of integers from 1 on, with 0 after each segment; patterns of up to `depth` (2 or more) symbols.

    Kept are the transform's planes, a bit a row where a group of rows sharing depth - 1 symbols begins, a bit a row where
    a group of two or more rows sharing depth symbols begins, and those groups' first positions. The suffix array is not.
    """

    def __init__(self, text: np.ndarray, symbols: int, depth: int):
        self.depth, n = depth, len(text)
        rank = np.concatenate([text, np.zeros(2 * depth + 2, text.dtype)]).astype(np.int32)
        size, half = 1, rank
        while size * 2 < depth:  # ranks of all stretches of size symbols, by sorting pairs
            half, size = self._rank_pairs(half, size), 2 * size
        # Two stretches that overlap cover any length from size to twice that.
        key = half[:n].astype(np.int64) * (int(half.max()) + 1) + half[depth - size : depth - size + n]
        rows = np.argsort(key, kind="stable").astype(np.int32)
        self.transform = WaveletMatrix(np.where(rows > 0, text[rows - 1], 0).astype(np.int32), symbols)
        self.first = self.transform.firsts(symbols)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        self.size = n
        key = key[rows]
        begins = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        del key
        shared = np.diff(np.append(begins, n)) > 1
        at = np.zeros(n + 1, bool)
        at[begins[shared]] = True
        self.repeated = BitVector(at)
        self.earliest = np.minimum.reduceat(rows, begins)[shared]
        c, d = half[rows], half[rows + (depth - 1 - size)]
        self.parents = BitVector(np.concatenate([[True], (c[1:] != c[:-1]) | (d[1:] != d[:-1]), [True]]))

    @staticmethod
    def _rank_pairs(rank: np.ndarray, size: int) -> np.ndarray:
        key = rank[:-size].astype(np.int64) * (int(rank.max()) + 1) + rank[size:]
        _, out = np.unique(key, return_inverse=True)
        return np.concatenate([out.astype(np.int32), np.zeros(size, np.int32)])

    def extend(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of symbol + match, from those of match."""
        twice = np.concatenate([symbol, symbol])
        ranks = self.transform.rank(twice, np.concatenate([low, high]), self.first[twice])
        return self.before[symbol] + ranks[: len(symbol)], self.before[symbol] + ranks[len(symbol) :]

    def shorten(self, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of matches of `depth` symbols without their last one."""
        group = self.parents.rank(low + 1)
        return self.parents.select(group - 1), self.parents.select(group)

    def first_place(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """First position of each match of `depth` symbols; -1 where it occurs once."""
        found = np.full(len(low), -1, np.int64)
        many = np.flatnonzero(high - low > 1)
        found[many] = self.earliest[self.repeated.rank(low[many])]
        return found


def repeated_windows(parts: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each segment begins in the text of all, and for every position the first one with an equal window, -1 for none.

    Segments are streamed through the index from their right ends, all in step."""
    words = [p.split() for p in parts]
    sizes = np.array([len(w) for w in words], np.int64)
    known: dict[bytes, int] = {}
    flat = np.fromiter((known.setdefault(w, len(known) + 1) for w in chain.from_iterable(words)), np.int64, int(sizes.sum()))
    begins = np.cumsum(sizes + 1) - sizes - 1
    text = np.zeros(int(sizes.sum()) + len(parts), np.int64)
    text[np.arange(len(flat)) + np.repeat(np.arange(len(parts)), sizes)] = flat
    del words, flat
    index = FmIndex(text, len(known) + 1, window)
    earliest = np.full(len(text), -1, np.int64)
    order = np.argsort(-sizes, kind="stable")
    long_first = sizes[order]
    low, high = np.zeros(len(parts), np.int64), np.full(len(parts), index.size, np.int64)
    for step in range(int(long_first[0]) if len(parts) else 0):
        active = int(np.searchsorted(-long_first, -step, side="left"))  # segments longer than step
        lo, hi = low[:active], high[:active]
        if step >= window:
            lo, hi = index.shorten(lo)
        at = begins[order[:active]] + long_first[:active] - 1 - step
        lo, hi = index.extend(lo, hi, text[at])
        low[:active], high[:active] = lo, hi
        if step >= window - 1:
            earliest[at] = index.first_place(lo, hi)
    return begins, earliest


_SPAN = "k1 long, k2 long, s int, e int"


def _search(window: int):
    """Rows shard, k1, k2, part by shard and first place -> intervals of a segment whose windows stand in an earlier one."""

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        k1, k2, parts = zip(*rows, strict=True)
        begins, earliest = repeated_windows(list(parts), window)
        segment = np.searchsorted(begins, np.arange(len(earliest)), side="right") - 1
        place = np.arange(len(earliest)) - begins[segment]
        # Segments stand in the order of their first places, so an earlier position is an earlier start.
        hit = (earliest >= 0) & (earliest < np.arange(len(earliest)))
        edge = np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
        k1, k2 = np.array(k1, np.int64), np.array(k2, np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(k1[segment[first]]), pa.array(k2[segment[first]]), pa.array(place[first].astype(np.int32)), pa.array((place[last] + window).astype(np.int32))], names=["k1", "k2", "s", "e"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, rows = None, []
        for batch in batches:
            for k, *row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if k != shard and rows:
                    yield flush(rows)
                    rows = []
                shard = k
                rows.append(row)
        if rows:
            yield flush(rows)

    return run


# ---------------------------------------------------------------- the whole job

_CUT = "doc_id long, th long, start int, n int, name long, k1 long, k2 long, part binary"
_WINDOWS = "k1 long, k2 long, doc0 long, place int, at int, w1 long, w2 long"


def _halves(digest: int) -> tuple[int, int]:
    return (digest >> 64) - (1 << 63), (digest & ((1 << 64) - 1)) - (1 << 63)


def _batches(rows: Iterator[tuple], schema: str, weight) -> Iterator[pa.RecordBatch]:
    """Rows as batches of a few MB."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    block, size = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*block, strict=True), fields, strict=True)], names=[n for n, _ in fields])

    for row in rows:
        block.append(row)
        size += weight(row)
        if size > 4_000_000:
            yield batch()
            block, size = [], 0
    if block:
        yield batch()


def _cut_segments(window: int):
    """Words and their hash of each found segment of a document."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            for i, (doc, th) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                words = texts[i].as_py().split()
                for x in batch.column(3)[i].as_py():
                    part = b" ".join(words[x["start"] : x["start"] + x["n"] + window - 1])
                    yield doc, th, x["start"], x["n"], x["name"], *_halves(xxhash.xxh3_128_intdigest(part)), part

    return lambda batches: _batches(rows(batches), _CUT, lambda row: len(row[-1]) + 60)


def _cut_windows(window: int):
    """Every window of a segment by its hash."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for k1, k2, doc, start, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = part.split()
                for at in range(len(words) - window + 1):
                    yield k1, k2, doc, start + at, at, *_halves(xxhash.xxh3_128_intdigest(b" ".join(words[at : at + window])))

    return lambda batches: _batches(rows(batches), _WINDOWS, lambda row: 60)


def _later_copies(keyed: DataFrame) -> DataFrame:
    """doc_id and th of documents whose whole text also stands under a smaller doc_id."""
    texts = keyed.select("doc_id", "th", F.xxhash64(F.lit(1), "text").alias("th2"))  # the text's hash from another seed
    first = texts.groupBy("th", "th2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("many")).filter("last > first")
    first = materialize(first.drop("last"), "repeat-texts")
    return by_counted_key(texts, first, ["th", "th2"], texts.count()).filter("doc_id > first").select("doc_id", "th").distinct()


def _segment_spans(distinct: DataFrame, params: RepeatParams) -> DataFrame:
    """k1, k2 and spans (s, e) of words that stand in a window of an earlier distinct segment, of segments that have any."""
    spark, window = distinct.sparkSession, params.window
    names = materialize(distinct.groupBy("name").agg(F.count("*").alias("many"), F.sum("n").alias("n")).filter("many > 1"), "repeat-groups")
    few = names.filter(F.col("many") <= params.max_group)
    total = few.agg(F.sum(F.col("n") + F.col("many") * (window - 1))).first()[0] or 0
    shards = max(1, total // params.words_per_shard)
    near = by_counted_key(distinct.select("name", "k1", "k2", "doc0", "start0", "part"), names.select("name", "many"), ["name"], distinct.count())
    cold = near.filter(F.col("many") <= params.max_group).withColumn("shard", F.pmod(F.xxhash64("name"), F.lit(shards)).cast("int"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cold = cold.select("shard", "k1", "k2", "part", "doc0", "start0").repartition(tasks, "shard").sortWithinPartitions("shard", "doc0", "start0").drop("doc0", "start0")
    spans = map_batches(cold, _search(window), _SPAN)
    if not names.filter(F.col("many") > params.max_group).isEmpty():
        hot = near.filter(F.col("many") > params.max_group).select("k1", "k2", "doc0", "start0", "part")
        windows = materialize(map_batches(hot, _cut_windows(window), _WINDOWS), "repeat-windows")
        first = windows.groupBy("w1", "w2").agg(F.min(F.struct("doc0", "place")).alias("first"), F.count("*").alias("many")).filter("many > 1")
        later = by_counted_key(windows, materialize(first, "repeat-first"), ["w1", "w2"], windows.count()).filter(F.struct("doc0", "place") > F.col("first"))
        spans = spans.union(later.select("k1", "k2", F.col("at").alias("s"), (F.col("at") + window).alias("e")))
    return materialize(spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("s", "e")).alias("spans")), "repeat-matches")


def repeat_spans(docs: DataFrame, params: RepeatParams = RepeatParams()) -> DataFrame:
    """doc_id, th (the text's hash), copy (the whole text is a later copy) and spans (s, e) of words to remove, for documents that have any."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text").filter("doc_id is not null and text is not null")
    copies = materialize(_later_copies(keyed), "repeat-copies")
    named = materialize(map_batches(keyed, _name_segments(params), "doc_id long, th long, start int, n int, name long"), "repeat-named", compression="zstd")
    counts = materialize(named.groupBy("name").agg(F.count("*").alias("many")).filter("many > 1"), "repeat-names")
    kept = by_counted_key(named, counts, ["name"], named.count()).groupBy("doc_id", "th").agg(F.collect_set(F.struct("start", "n", "name")).alias("found"))
    found = materialize(kept.join(copies, ["doc_id", "th"], "left_anti"), "repeat-found")
    discard(named, counts)
    rows = keyed.join(found, ["doc_id", "th"]).select("doc_id", "th", "text", "found")
    rows = materialize(map_batches(rows, _cut_segments(params.window), _CUT), "repeat-segments", compression="zstd")
    discard(found)
    first = F.min(F.struct("doc_id", "start")).alias("at")
    distinct = rows.groupBy("k1", "k2").agg(first, F.count("*").alias("many"), F.first("name").alias("name"), F.first("n").alias("n"), F.first("part").alias("part"))
    distinct = materialize(distinct.select("k1", "k2", "name", "n", "many", F.col("at.doc_id").alias("doc0"), F.col("at.start").alias("start0"), "part"), "repeat-distinct", compression="zstd")
    matches = _segment_spans(distinct, params)
    known = distinct.select("k1", "k2", "many", "doc0", "start0").join(matches, ["k1", "k2"], "left").filter("many > 1 or spans is not null")
    known = materialize(known, "repeat-known")
    place = by_counted_key(rows.select("doc_id", "th", "start", "n", "k1", "k2"), known, ["k1", "k2"], rows.count())
    whole = F.array(F.struct(F.col("start").alias("s"), (F.col("start") + F.col("n") + (params.window - 1)).alias("e")))
    part = F.transform("spans", lambda x: F.struct((x["s"] + F.col("start")).alias("s"), (x["e"] + F.col("start")).alias("e")))
    later = F.struct("doc_id", "start") > F.struct("doc0", "start0")
    spans = place.select("doc_id", "th", F.explode(F.when(later, whole).otherwise(part)).alias("x")).groupBy("doc_id", "th").agg(F.collect_set("x").alias("spans"))
    gone = copies.select("doc_id", "th", F.lit(True).alias("copy"), F.lit(None).cast("array<struct<s:int,e:int>>").alias("spans"))
    out = materialize(spans.select("doc_id", "th", F.lit(False).alias("copy"), "spans").union(gone), "repeat-spans")
    discard(rows, distinct, matches, known, copies)
    return out


def kept_words(words: list[bytes], copy: bool | None, spans, window: int) -> list[bytes]:
    if copy:
        return words if len(words) < window else []
    if not spans:
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    for x in spans:
        gone[x["s"]] += 1
        gone[x["e"]] -= 1
    covered = np.cumsum(gone[:-1]) > 0
    return [w for w, g in zip(words, covered.tolist(), strict=True) if not g]


def _joined(docs: DataFrame, spans: DataFrame, columns: list[str]) -> DataFrame:
    """columns of docs, then copy and spans; helper columns take names that docs does not have."""
    ident, th, copy, found = spare(docs, "_id", "_th", "_copy", "_spans")
    keyed = docs.select(*columns, F.col("doc_id").cast("long").alias(ident), F.xxhash64("text").alias(th))
    marks = spans.select(F.col("doc_id").alias(ident), F.col("th").alias(th), F.col("copy").alias(copy), F.col("spans").alias(found))
    return keyed.join(marks, [ident, th], "left").select(*columns, copy, found)


def repeat_report(docs: DataFrame, params: RepeatParams = RepeatParams()) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 (of the kept words joined by one space) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, gone, sha = [], [], []
            texts = batch.column(1).cast(pa.binary())
            for t, copy, spans in zip(texts, batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                words = (t.as_py() or b"").split()
                kept = kept_words(words, copy, spans, params.window)
                n.append(len(words))
                gone.append(len(words) - len(kept))
                sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    joined = _joined(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), repeat_spans(docs, params), ["doc_id", "text"])
    return map_batches(joined, run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, params: RepeatParams = RepeatParams()) -> DataFrame:
    """docs with repeated words removed from text; a text that loses nothing stays as it is, else kept words are joined by one space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            where = names.index("text")
            out = []
            for t, copy, spans in zip(batch.column(where), batch.column(len(names) - 2).to_pylist(), batch.column(len(names) - 1).to_pylist(), strict=True):
                text = t.as_py()
                if text is not None and (copy or spans):
                    words = text.encode().split()
                    kept = kept_words(words, copy, spans, params.window)
                    text = text if len(kept) == len(words) else b" ".join(kept).decode()
                out.append(text)
            columns = batch.columns[:-2]
            columns[where] = pa.array(out, batch.schema.field(where).type)
            yield pa.RecordBatch.from_arrays(columns, names=names[:-2])

    return map_batches(_joined(docs, repeat_spans(docs, params), docs.columns), run, docs.schema)

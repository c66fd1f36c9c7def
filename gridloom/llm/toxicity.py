"""Toxicity: boosted trees over dense features of a text, with isotonic calibration.

Training reads labels of the training fold only, and of those a sample whose expected size is `max_train_rows`
(a documented bound; rows are chosen by a hash of doc_id). Two lexicons are learned there: whole words, and word
stems, each with its log odds. Counts behind them are grouped in Spark; at most `lexicon_size` entries reach the
driver. Features are rates, so they do not grow with the text. Every text is scored whole, in one pass.

Defined results. Null and empty text: the features of no words, hence one fixed score. Repeated rows: equal scores.
Rows without doc_id: scored, and counted as not held out. Very long texts: whole, one at a time. Conflicting labels of one
doc_id: toxic if one says so. No labels, or labels of one kind only: score 0 everywhere.
Empty table: empty result. Extra columns are dropped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import WORD, discard, map_batches, materialize


@dataclass(frozen=True)
class ToxicityParams:
    #: Expected number of labelled rows that training reads, whatever the corpus's size.
    max_train_rows: int = 12_000
    lexicon_size: int = 400
    min_toxic_docs: int = 5
    min_log_odds: float = 2.0
    stem_lengths: tuple[int, ...] = (4, 5)
    trees: int = 60
    depth: int = 3
    learning_rate: float = 0.2
    bins: int = 64
    threshold: float = 0.7


#: Second person in four languages.
SECOND = frozenset("you your yours du dein deine dich dir ihr tu te ti vous ton votre toi usted tus vosotros".split())
#: Characters that stand for letters in disguised words.
DISGUISE = str.maketrans("013457@$!", "oieastasi")
EDGE = ".,;:!?\"'()[]{}«»¿¡-"
#: A letter, then digits or symbols, then a letter: a disguised word.
HIDDEN = re.compile(r"[^\W\d_][0-9@$*#!._]+[^\W\d_]")
NAMES = ("word_rate", "word_weight", "stem_rate", "stem_weight", "any_hits", "near_second", "second_rate", "upper_words", "upper_chars", "exclaim", "punct", "hidden", "hidden_hits")


def features(text: str, words: dict[str, float], stems: dict[str, float], lengths: tuple[int, ...]) -> list[float]:
    tokens = text.encode().split()  # ASCII white space
    n = len(tokens)
    if not n:
        return [0.0] * len(NAMES)
    hits = stem_hits = hidden = hidden_hits = second = upper = near = 0
    weight = stem_weight = 0.0
    last_second = last_hit = -100
    for i, raw in enumerate(tokens):
        token = raw.decode().strip(EDGE)
        word = token.lower()
        if len(token) > 1 and token.isupper():
            upper += 1
        if word in SECOND:
            second += 1
            last_second = i
            near += i - last_hit <= 5
            continue
        found = words.get(word)
        if found is None and not word.isalpha() and HIDDEN.search(word):
            hidden += 1
            plain = word.translate(DISGUISE)
            found = words.get("".join(c for c in plain if c.isalpha()))
            hidden_hits += found is not None
        if found is not None:
            hits += 1
            weight += found
        else:
            for k in lengths:
                if (found := stems.get(word[:k])) is not None:
                    stem_hits += 1
                    stem_weight += found
                    break
        if found is not None:
            near += i - last_second <= 5
            last_hit = i
    chars = len(text)
    some = hits + stem_hits
    marks = text.count("!") + text.count("?")
    stops = text.count(".") + text.count(",")
    return [
        100 * hits / n, 100 * weight / n, 100 * stem_hits / n, 100 * stem_weight / n, float(min(some, 8)), 100 * near / n, 100 * second / n,
        upper / n, sum(map(str.isupper, text)) / chars if not text.islower() else 0.0, 100 * marks / chars, 100 * stops / chars, 100 * hidden / n, 100 * hidden_hits / n,
    ]


@dataclass
class Trees:
    """Complete binary trees: split feature and threshold by node in level order, then leaf values."""

    depth: int
    base: float = 0.0
    feature: list[np.ndarray] = field(default_factory=list)
    threshold: list[np.ndarray] = field(default_factory=list)
    leaf: list[np.ndarray] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, t, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            out += leaf[node - (2**self.depth - 1)]
        return out


def fit_trees(x: np.ndarray, y: np.ndarray, params: ToxicityParams) -> Trees:
    """Gradient boosting on the logistic loss, with histograms of each feature and Newton leaves."""
    n, k = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, params.bins + 1)[1:-1])) for j in range(k)]
    code = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    width = max(len(c) for c in cuts) + 1
    p = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    model = Trees(params.depth, float(np.log(p / (1 - p))))
    margin = np.full(n, model.base)
    inner = 2**params.depth - 1
    for _ in range(params.trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        f, t = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(params.depth):
            first, count = 2**level - 1, 2**level
            at = node - first
            best = np.full(count, 1e-6)
            for j in range(k):
                slot = at * width + code[:, j]
                g = np.bincount(slot, grad, count * width).reshape(count, width).cumsum(axis=1)
                h = np.bincount(slot, hess, count * width).reshape(count, width).cumsum(axis=1)
                gl, hl, gt, ht = g[:, :-1], h[:, :-1], g[:, -1:], h[:, -1:]
                gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
                gain = gain[:, : len(cuts[j])]
                if not gain.shape[1]:
                    continue
                top = gain.argmax(axis=1)
                for q in range(count):
                    if gain[q, top[q]] > best[q]:
                        best[q], f[first + q], t[first + q] = gain[q, top[q]], j, cuts[j][top[q]]
            node = 2 * node + 1 + (x[np.arange(n), f[node]] > t[node])
        at = node - inner
        leaf = params.learning_rate * np.bincount(at, grad, inner + 1) / (np.bincount(at, hess, inner + 1) + 1)
        margin += leaf[at]
        model.feature.append(f), model.threshold.append(t), model.leaf.append(leaf)
    return model


def fit_isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of a nondecreasing step function by pooling adjacent violators; equal scores are pooled first."""
    at, where = np.unique(score, return_inverse=True)
    weight = np.bincount(where).astype(float)
    mean = np.bincount(where, y) / weight
    blocks: list[list[float]] = []  # mean, weight, first point, last point
    for i in range(len(at)):
        blocks.append([mean[i], weight[i], at[i], at[i]])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b, a = blocks.pop(), blocks.pop()
            w = a[1] + b[1]
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / w, w, a[2], b[3]])
    xs, ys = [], []
    for m, _, lo, hi in blocks:
        xs += [lo] if lo == hi else [lo, hi]
        ys += [m] if lo == hi else [m, m]
    return np.array(xs), np.array(ys)


@dataclass
class ToxicityModel:
    words: dict[str, float]
    stems: dict[str, float]
    trees: Trees | None
    points: tuple[np.ndarray, np.ndarray] | None
    params: ToxicityParams

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.trees is None or not texts:
            return np.zeros(len(texts))
        x = np.array([features(t, self.words, self.stems, self.params.stem_lengths) for t in texts])
        return self.calibrated(self.trees.margin(x))

    def calibrated(self, margin: np.ndarray) -> np.ndarray:
        """The isotonic curve decides; a thousandth of the raw probability keeps the order inside its flat parts."""
        flat = np.interp(margin, *self.points)
        return np.clip(0.999 * flat + 0.001 / (1 + np.exp(-margin)), 0.0, 1.0)


def fold(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3, F.lit(0))


def _lexicon(sample: DataFrame, params: ToxicityParams) -> tuple[dict[str, float], dict[str, float]]:
    """Words and stems that stand in far more toxic than clean documents of the sample."""
    raw = F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1))))
    tokens = sample.select("toxic", "doc_id", raw.alias("w")).withColumn("w", F.lower(F.trim("w", F.lit(EDGE)))).filter("length(w) > 1")
    kinds = [F.struct(F.lit(0).alias("k"), F.col("w").alias("w"))] + [F.struct(F.lit(k).alias("k"), F.when(F.length("w") > k, F.substring("w", 1, k)).alias("w")) for k in params.stem_lengths]
    entries = tokens.select("toxic", "doc_id", F.explode(F.array(*kinds)).alias("e")).select("toxic", "doc_id", "e.k", "e.w").filter("w is not null").distinct()
    counts = entries.groupBy("k", "w").agg(F.sum("toxic").alias("t"), F.count("*").alias("n")).filter(F.col("t") >= params.min_toxic_docs)
    totals = sample.agg(F.sum("toxic").alias("t"), F.count("*").alias("n")).first()
    odds = F.log((F.col("t") + 0.5) / (totals["t"] + 1)) - F.log((F.col("n") - F.col("t") + 0.5) / (totals["n"] - totals["t"] + 1))
    top = counts.withColumn("o", odds).filter(F.col("o") >= params.min_log_odds)
    words, stems = ({r["w"]: float(r["o"]) for r in top.filter(kind).orderBy(F.desc("o"), "w").limit(params.lexicon_size).collect()} for kind in ("k = 0", "k > 0"))
    return words, stems


def train(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> ToxicityModel:
    """Learn from labelled rows outside the held-out fold. labels: doc_id, toxic."""
    known = labels.select(F.col("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic in (0, 1)").filter(fold() != 1)
    n = known.count()
    share = min(1.0, params.max_train_rows / max(1, n))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    chosen = known.filter(place < int(share * (1 << 20))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = F.broadcast(chosen)  # max_train_rows bounds it
    sample = materialize(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(chosen, "doc_id"), "toxicity-sample")
    kinds = {r["toxic"] for r in sample.select("toxic").distinct().collect()}
    if kinds != {0, 1}:
        discard(sample)
        return ToxicityModel({}, {}, None, None, params)
    words, stems = _lexicon(sample, params)
    k = len(NAMES)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t.as_py(), words, stems, params.stem_lengths) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64(), -1)), batch.column(2)], names=["doc_id", "x", "toxic"])

    got = map_batches(sample.select("doc_id", "text", "toxic"), rows, "doc_id long, x array<double>, toxic int").toArrow().to_pandas().sort_values("doc_id")
    discard(sample)
    x, y = np.array(got["x"].tolist()).reshape(-1, k), got["toxic"].to_numpy(float)
    # Calibration needs margins of rows that the trees did not see: two halves judge each other.
    half = np.arange(len(y)) % 2
    margin = np.empty(len(y))
    for h in (0, 1):
        margin[half == h] = fit_trees(x[half != h], y[half != h], params).margin(x[half == h])
    return ToxicityModel(words, stems, fit_trees(x, y, params), fit_isotonic(margin, y), params)


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = model.scores([t.as_py() or "" for t in part.column(2)])
                label = pa.array((found >= model.params.threshold).astype(np.int32))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found), label], names=["doc_id", "held_out", "score", "predicted"])

    return map_batches(docs.select("doc_id", (fold() == 1).alias("held_out"), "text"), run, "doc_id long, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows of docs, with all columns of any name, whose score stays below the threshold. Null and empty texts have the
    score of no words; equal rows stay or go together; an empty table stays empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = model.scores([t.as_py() or "" for t in part.column(part.schema.names.index("text"))])
                yield part.filter(pa.array(found < model.params.threshold))

    return map_batches(docs, run, docs.schema)

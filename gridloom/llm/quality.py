"""Quality rules by distribution divergence. DataFrame expressions only.

Each document becomes two small histograms: character classes, and counts of its language's common words. Those words are
learned: for every language, the `common_words` words that stand in most of its documents. A language's reference is the
same two histograms summed over all its documents that pass the base rules. A document is kept if it passes the base
rules and the Jensen-Shannon distance of both histograms to its own language's reference is below the limit. Counts below
the minimum length say too little, and that histogram is then not judged.

A language has a reference if it holds `min_share` of the documents and `min_reference_words` words that pass the base rules.
The share bounds the number of references (1 / min_share), so they can be broadcast whatever the input.

Defined results. Null text: no words, base_failed. Empty text: the same. Very long texts: whole, their words one array. Ties
and repeated rows: each row is judged alone, so equal rows get equal results; words that stand in equally many documents
are taken in the order of their letters. Empty table: empty result. Other columns of the input are dropped, so names
cannot clash. A document whose language has no reference, or that has no language, is not compared with other languages: it
is kept if it passes the base rules, and its distances are null.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import WORD, discard, materialize

SPACE = r"[\x20\x09-\x0D]+"
MARKS = ".,;:!?"
BASE = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
CLASSES = ("lower", "upper", "digit", "space", "punct", "other")


@dataclass(frozen=True)
class QualityParams:
    #: Words in a language's histogram, beside the rest.
    common_words: int = 32
    #: Limits are base + slack / sqrt(length): a short text's histogram is noisier, and one number moves it more. The four
    #: values were chosen on labelled rows (`labels.quality` of 3,534 documents); they are not learned by a run.
    class_base: float = 0.13
    class_slack: float = 2.0
    word_base: float = 0.2
    word_slack: float = 1.35
    #: Characters and words from which the class and the word histogram count.
    min_chars: int = 200
    min_words: int = 60
    #: A language's reference needs this many words, and this share of the documents.
    min_reference_words: int = 2_000
    min_share: float = 0.0001


def base_counts(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, keep, text, words, and the base columns of every whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    one = docs.select("doc_id", *keep, text.alias("text"))
    two = one.withColumn("words", F.array_remove(F.split("text", SPACE), "")).withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    grams = F.transform(F.slice("hashes", 1, F.greatest(F.size("hashes") - 2, F.lit(0))), lambda h, i: F.xxhash64(h, F.get("hashes", i + 1), F.get("hashes", i + 2)))
    three = two.withColumn("grams", grams).withColumn("lines", F.filter(F.split("text", "\n", -1), lambda x: x.rlike(WORD)))
    # Windows found again: sort (hash, place), keep those equal to a neighbour. Most texts have none and skip the sort.
    placed = F.when(F.size(F.array_distinct("grams")) < F.size("grams"), F.sort_array(F.transform("grams", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    four = three.withColumn("placed", placed)
    five = four.withColumn("again", F.sort_array(F.transform(F.filter("placed", lambda x, i: F.coalesce(F.when(i > 0, F.get("placed", i - 1)["h"] == x["h"]), F.lit(False)) | F.coalesce(F.get("placed", i + 1)["h"] == x["h"], F.lit(False))), lambda x: x["i"])))
    covered = F.aggregate(
        F.transform("again", lambda p, j: F.least(F.lit(3), F.coalesce(F.get("again", j + 1) - p, F.lit(3)))), F.lit(0).cast("bigint"), lambda a, x: a + x
    )
    return five.select(
        "doc_id",
        *keep,
        "text",
        "words",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.regexp_replace("text", SPACE, "")).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"),
    ).withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def common_form(word: Column) -> Column:
    """A word in lower case without marks behind it."""
    return F.rtrim(F.lower(word), F.lit(MARKS))


def learn_words(docs: DataFrame, params: QualityParams) -> DataFrame:
    """lang and vocabulary: of each language with its share of the documents, the words that stand in most of them.

    Counts are summed before they are shuffled, and Spark limits each partition's rank before it ranks a language.
    """
    sizes = materialize(docs.filter("lang is not null").groupBy("lang").agg(F.count("*").alias("n")), "quality-languages")
    known = sizes.filter(F.col("n") >= params.min_share * docs.count()).select("lang")
    forms = F.array_distinct(F.transform(F.array_distinct(F.split(F.coalesce("text", F.lit("")), SPACE)), common_form))
    words = docs.join(F.broadcast(known), "lang").select("lang", F.explode(forms).alias("w")).filter("w <> ''")
    counts = words.groupBy("lang", "w").agg(F.count("*").alias("n"))
    top = counts.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "w"))).filter(F.col("r") <= params.common_words)
    listed = F.transform(F.sort_array(F.collect_list(F.struct("r", "w"))), lambda x: x["w"])
    out = materialize(top.groupBy("lang").agg(listed.alias("vocabulary")), "quality-words")
    discard(sizes)
    return out


def histograms(counted: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Adds classes and common: counts by character class, and by common word with the rest last (null without vocabulary)."""
    left = lambda keep: F.length(F.regexp_replace("text", f"[^{keep}]+", "")).cast("bigint")
    # common_words rows a language. Membership in a literal set costs next to nothing beside a search through an array.
    words = [r[0] for r in vocabulary.select(F.explode("vocabulary")).distinct().collect()]
    hits = F.sort_array(F.filter(F.transform("words", common_form), lambda w: w.isin(words))) if words else F.array().cast("array<string>")
    one = (
        counted.join(F.broadcast(vocabulary), "lang", "left")
        .withColumn("u", left(r"\p{Lu}"))
        .withColumn("d", left(r"\p{N}"))
        .withColumn("p", left(r".,;:!?'\"()\-"))
        .withColumn("l", F.col("word_chars") - F.length(F.regexp_replace("text", r"[\p{Ll}\x20\x09-\x0D]+", "")))
        .withColumn("s", F.length("text") - F.col("word_chars"))
        .withColumn("hits", hits)
        .withColumn("met", F.array_distinct("hits"))
    )
    # In sorted words, a word's count is the way from the last place of the word before it to its own.
    ends = F.transform("hits", lambda w, i: F.when(F.get("hits", i + 1) == w, F.lit(None).cast("int")).otherwise(i + 1))
    one = one.withColumn("ends", F.concat(F.array(F.lit(0)), F.array_compact(ends)))
    place = F.transform("vocabulary", lambda k: F.array_position("met", k).cast("int"))
    one = one.withColumn("known", F.transform(place, lambda i: F.when(i > 0, F.get("ends", i) - F.get("ends", i - 1)).otherwise(0).cast("bigint")))
    common = F.concat("known", F.array(F.col("n_words") - F.aggregate("known", F.lit(0).cast("bigint"), lambda a, x: a + x)))
    return one.withColumn("classes", F.array("l", "u", "d", "s", "p", F.col("word_chars") - F.col("l") - F.col("u") - F.col("d") - F.col("p"))).withColumn("common", common)


def fit_references(features: DataFrame, params: QualityParams) -> DataFrame:
    """lang, class_shares and word_shares of each language with enough words: sums over all its documents that pass the base rules."""
    n, m = len(CLASSES), params.common_words + 1
    sums = [F.sum(F.col("classes")[i]).alias(f"c{i}") for i in range(n)] + [F.sum(F.get("common", F.lit(i))).alias(f"w{i}") for i in range(m)]
    summed = features.filter("not base_failed and common is not null").groupBy("lang").agg(F.sum("n_words").alias("n"), *sums)
    listed = lambda k, size: F.array_compact(F.array(*[F.col(f"{k}{i}") for i in range(size)]))
    shares = lambda counts: F.transform(counts, lambda x: x / F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, y: a + y))
    rows = summed.filter(F.col("n") >= params.min_reference_words).select("lang", shares(listed("c", n)).alias("class_shares"), shares(listed("w", m)).alias("word_shares"))
    return materialize(rows, "quality-references")


def distance(counts: Column, total: Column, shares: Column) -> Column:
    """Jensen-Shannon distance, base 2, of a histogram and a reference's shares; null where either is missing or empty."""
    bits = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))

    def term(c: Column, q: Column) -> Column:
        p = c / total
        m = (p + q) / 2
        return bits(p, m) / 2 + bits(q, m) / 2

    spread = F.aggregate(F.zip_with(counts, shares, term), F.lit(0.0), lambda a, x: a + x)
    return F.when((total > 0) & shares.isNotNull() & counts.isNotNull(), F.sqrt(F.greatest(spread, F.lit(0.0))))


def verdicts(features: DataFrame, references: DataFrame, params: QualityParams, keep: tuple[str, ...] = ()) -> DataFrame:
    """keep, the base columns, the distances to the language's reference, and kept."""
    size = F.aggregate("classes", F.lit(0).cast("bigint"), lambda a, x: a + x)
    near = lambda c, w: (F.col(c).isNull() | (size < params.min_chars) | (F.col(c) <= params.class_base + params.class_slack / F.sqrt(size))) & (
        F.col(w).isNull() | (F.col("n_words") < params.min_words) | (F.col(w) <= params.word_base + params.word_slack / F.sqrt("n_words"))
    )
    joined = features.join(F.broadcast(references), "lang", "left")
    judged = joined.withColumn("class_distance", distance(F.col("classes"), size, F.col("class_shares"))).withColumn("word_distance", distance(F.col("common"), F.col("n_words"), F.col("word_shares")))
    return judged.select(*keep, *BASE, "class_distance", "word_distance", (~F.col("base_failed") & near("class_distance", "word_distance")).alias("kept"))


def quality_rules(docs: DataFrame, params: QualityParams = QualityParams(), lang: str = "lang") -> DataFrame:
    """doc_id, the base columns, class_distance and word_distance to the language's reference, and kept."""
    docs = docs.select("doc_id", "text", (F.col(lang) if lang in docs.columns else F.lit(None)).cast("string").alias("lang"))
    features = materialize(histograms(base_counts(docs, ("lang",)), learn_words(docs, params)).select("lang", *BASE, "classes", "common"), "quality")
    return verdicts(features, fit_references(features, params), params)


def keep_good(docs: DataFrame, params: QualityParams = QualityParams(), lang: str = "lang") -> DataFrame:
    """The rows of docs, with all columns, that the rules keep.

    Rows and histograms are written once to the shared folder: references need a pass over all of them before a row can
    be judged, and the histograms cost more than the copy. No text is shuffled. Nulls, very long texts, repeated rows and
    empty tables: as above, and a row is kept or dropped as a whole. Columns of any name pass through.
    """
    names = docs.columns
    rows = docs.select(F.struct(*names).alias("_row"), "doc_id", "text", (F.col(lang) if lang in names else F.lit(None)).cast("string").alias("lang"))
    features = materialize(histograms(base_counts(rows, ("lang", "_row")), learn_words(rows, params)).select("_row", "lang", *BASE, "classes", "common"), "quality-rows")
    return verdicts(features, fit_references(features, params), params, ("_row",)).filter("kept").select("_row.*")

import re
from collections import Counter

from pyspark.sql import functions as F

from gridloom.llm.quality import QualityParams, base_counts, histograms, keep_good, learn_words, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    grams = Counter(zip(words, words[1:], words[2:], strict=False))
    hit = set()
    for i in range(len(words) - 2):
        if grams[tuple(words[i : i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit), n < 50 or 100 * len(hit) > 50 * n


def rows(df):
    return {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in df.collect()}


def test_base_counts_match_brute_force(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    assert rows(quality_rules(docs)) == {r.doc_id: base(r.text) for r in docs.collect()}


def test_odd_texts(spark):
    texts = [None, "", " \n\t", "a", "a b", "a b c", "a b c a b c", "x " * 40, "\n\na b\na b\n c\n\n c", "é é | ### <b>", "a\x0bb\x0cc\rd", " lead", "tail "]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("words", F.lit(1)).withColumn("n_words", F.lit("clash"))
    assert rows(quality_rules(docs)) == {i: base(t) for i, t in enumerate(texts)}
    assert quality_rules(docs.limit(0)).count() == 0
    assert not any(r.kept for r in quality_rules(docs).collect())


def test_divergence_parts_junk_from_prose(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality_rules(docs).join(labels, "doc_id").filter("not base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept"), F.count("*").alias("n")).collect()
    kept = {r.quality: r.kept for r in got}
    assert kept[1] > 0.98
    assert kept[0] < 0.4


def test_languages_without_a_reference_are_not_judged(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    foreign = " ".join(f"слово{i} ещё{i * 7}" for i in range(150))
    odd = [(90_000, foreign, "ru"), (90_001, foreign, None), (90_002, foreign, "en"), (90_003, "слово " * 200, "ru")]
    both = docs.union(spark.createDataFrame(odd, "doc_id long, text string, lang string"))
    got = {r.doc_id: r for r in quality_rules(both).filter("doc_id >= 90000").collect()}
    assert {i: r.kept for i, r in got.items()} == {90_000: True, 90_001: True, 90_002: False, 90_003: False}
    assert got[90_000].class_distance is None and got[90_002].class_distance is not None
    assert {r.doc_id for r in keep_good(both).filter("doc_id >= 90000").collect()} == {90_000, 90_001}


def test_every_language_has_its_own_words(spark):
    """The same texts under a name that no list knows are judged the same."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    renamed = docs.withColumn("lang", F.when(F.col("lang") == "de", "pl").otherwise(F.col("lang")))
    kept = lambda df: {(r.doc_id, r.kept) for r in quality_rules(df).collect()}
    assert kept(docs) == kept(renamed)


def test_common_words(spark):
    texts = ["The the cat, cat!", "a cat... the ... dog", "dog. a!?\n", None, "", "x" * 9 + ".,;" * 4000]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    params = QualityParams(common_words=4)
    words = learn_words(docs, params).collect()
    assert [(r.lang, r.vocabulary) for r in words] == [("en", ["a", "cat", "dog", "the"])]
    got = {r.doc_id: r.common for r in histograms(base_counts(docs, ("lang",)), learn_words(docs, params)).collect()}
    assert got == {0: [0, 2, 0, 2, 0], 1: [1, 1, 1, 1, 1], 2: [1, 0, 1, 0, 0], 3: [0] * 5, 4: [0] * 5, 5: [0, 0, 0, 0, 1]}


def test_very_long_texts_and_clashing_columns(spark):
    long = " ".join(f"w{i % 70_000}" for i in range(150_000)) + "\n" + "!" * 300_000
    docs = spark.createDataFrame([(1, long, "en"), (1, long, "en"), (2, "short", None)], "doc_id long, text string, lang string")
    for name in ("words", "hits", "vocabulary", "kept", "_row", "classes"):
        docs = docs.withColumn(name, F.lit("clash"))
    assert [r for r in rows(quality_rules(docs)).items()] == [(1, base(long)), (2, base("short"))] and quality_rules(docs).count() == 3
    assert keep_good(docs).columns == docs.columns and keep_good(docs.limit(0)).count() == 0

import zlib

import numpy as np
from pyspark.sql import functions as F

from gridloom.llm.toxicity import NAMES, ToxicityModel, ToxicityParams, drop_toxic, features, fit_isotonic, fit_trees, score, train

DATA = "/root/testdata/sf0.1"


def test_trees_learn_an_interaction():
    r = np.random.default_rng(1)
    x = r.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.3)).astype(float)
    model = fit_trees(x[:2000], y[:2000], ToxicityParams(trees=40))
    assert ((model.margin(x[2000:]) > 0) == y[2000:]).mean() > 0.95


def test_isotonic_never_falls_and_keeps_the_mean():
    r = np.random.default_rng(2)
    s = r.normal(size=500).round(1)
    y = (r.random(500) < 1 / (1 + np.exp(-3 * s))).astype(float)
    xs, ys = fit_isotonic(s, y)
    assert (np.diff(xs) > 0).all() and (np.diff(ys) >= 0).all()
    assert abs(np.interp(s, xs, ys).mean() - y.mean()) < 1e-9


def test_features_are_rates():
    words, stems = {"scum": 5.0}, {"lowe": 3.0}
    f = dict(zip(NAMES, features("You are SCUM! sc0m loweiß", words, stems, (4,)), strict=True))
    assert f["word_rate"] == 20 and f["stem_rate"] == 20 and f["upper_words"] == 0.2 and f["near_second"] > 0 and f["hidden"] == 20
    assert features("", words, stems, (4,)) == [0.0] * len(NAMES) == features(" \n", words, stems, (4,))
    once, often = (features(t, words, stems, (4,)) for t in ("scum a b c ", "scum a b c " * 50))
    assert once[0] == often[0]


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    rows = score(docs, train(docs, labels)).join(labels, "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    held = [r for r in rows if r.held_out]
    toxic, clean = [r for r in held if r.toxic], [r for r in held if not r.toxic]
    assert sum(r.predicted for r in toxic) / len(toxic) > 0.88
    assert sum(r.predicted for r in clean) / len(clean) < 0.02


def test_held_out_labels_are_never_read(spark, tiny):
    docs, labels = spark.read.parquet(f"{tiny}/documents.parquet"), spark.read.parquet(f"{tiny}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    key = lambda df: sorted((r.doc_id, r.score) for r in df.collect())
    assert key(score(docs, train(docs, labels))) == key(score(docs, train(docs, turned)))


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "x " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    nothing = train(docs, empty)
    assert [r.score for r in score(docs, nothing).collect()] == [0.0] * 5
    one_kind = train(docs, spark.createDataFrame([(2, 1, 0), (3, 1, 0)], "doc_id long, quality int, toxic int"))
    assert drop_toxic(docs, one_kind).count() == 5
    assert score(docs.limit(0), nothing).count() == 0
    both = train(docs, spark.createDataFrame([(2, 1, 0), (3, 1, 1), (1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int"))
    assert isinstance(both, ToxicityModel)
    got = score(docs, both).collect()
    assert len(got) == 5 and len({r.score for r in got if r.doc_id in (1, 2)}) == 1

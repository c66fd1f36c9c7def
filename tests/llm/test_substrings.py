import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from gridloom.llm.substrings import BitVector, FmIndex, RepeatParams, WaveletMatrix, remove_repeats, repeat_report

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows, window=20):
    seen, out = {}, {}
    for i, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        words = WORD.findall(text or "")
        for at in range(len(words) - window + 1):
            seen.setdefault(tuple(words[at : at + window]), (i, at))
    for i, text in rows:
        words = WORD.findall(text or "")
        gone = set()
        for at in range(len(words) - window + 1):
            if i is not None and seen[tuple(words[at : at + window])] < (i, at):
                gone |= set(range(at, at + window))
        kept = [w for k, w in enumerate(words) if k not in gone]
        out[i] = (len(words), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


def result(df):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()}


def test_wavelet_ranks():
    r = np.random.default_rng(1)
    s = r.integers(0, 37, 500)
    m = WaveletMatrix(s, 37)
    first = m.firsts(37)
    for c in range(37):
        at = np.arange(501)
        got = m.rank(np.full(501, c), at, first[np.full(501, c)])
        assert got.tolist() == [int((s[:i] == c).sum()) for i in at]


def test_backward_search_counts():
    r = np.random.default_rng(2)
    for depth in (2, 3, 5, 8, 20):
        text = np.append(r.integers(0, 4, 399), 0)  # a separator ends the text
        index = FmIndex(text, 4, depth)
        line = "".join(map(str, text))
        for _ in range(60):
            at, n = int(r.integers(0, 350)), int(r.integers(1, depth + 1))
            pattern = text[at : at + n]
            if 0 in pattern:
                continue
            lo, hi = np.array([0]), np.array([400])
            for c in pattern[::-1]:
                lo, hi = index.extend(lo, hi, np.array([c]))
            p = "".join(map(str, pattern))
            assert hi[0] - lo[0] == sum(line.startswith(p, i) for i in range(400))
            if n == depth:
                assert index.first_place(lo, hi)[0] == (line.find(p) if hi[0] - lo[0] > 1 else -1)
                a, b = index.shorten(lo)
                assert b[0] - a[0] == sum(line.startswith(p[:-1], i) for i in range(400))


def test_bit_vector():
    r = np.random.default_rng(3)
    for n, share in ((1, 1.0), (64, 0.5), (1000, 0.02), (1000, 0.9)):
        flags = r.random(n) < share
        bits = BitVector(flags)
        assert bits.rank(np.arange(n + 1)).tolist() == [int(flags[:i].sum()) for i in range(n + 1)]
        ones = np.flatnonzero(flags)
        assert bits.select(np.arange(len(ones))).tolist() == ones.tolist()


def test_matches_brute_force(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = plain(rows)
    assert sum(v[1] > 0 for v in want.values()) > 5
    for params in (RepeatParams(), RepeatParams(max_group=2, words_per_shard=500)):
        assert result(repeat_report(docs, params)) == want


def test_shared_passages_and_odd_rows(spark):
    r = random.Random(7)
    word = lambda: r.choice(["a", "b", "cc", "Ä", "e,"]) + str(r.randrange(40))
    run = lambda n: [word() for _ in range(n)]
    passages = [run(n) for n in (19, 20, 21, 45, 130)]
    rows = []
    for i in range(60):
        parts = [run(r.randint(0, 15)), r.choice(passages), run(r.randint(0, 15)), r.choice(passages), ["z"] * r.choice([0, 0, 50])]
        rows.append((i * 3, r.choice([" ", "\n", "\t "]).join(w for p in parts for w in p)))
    rows += [(900, None), (901, ""), (902, " \n"), (903, rows[0][1]), (904, rows[0][1]), (905, "q " * 19), (906, "q " * 300), (907, "q " * 19)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("th", "spans", "copy", "_id", "_TH", "_copy", "_spans", "part", "found", "many"):
        docs = docs.withColumn(name, F.lit("clash"))
    want = plain(rows)
    for params in (RepeatParams(), RepeatParams(max_group=3, words_per_shard=100)):
        assert result(repeat_report(docs, params)) == want
    twice = docs.union(docs.limit(5))
    assert repeat_report(twice).count() == len(rows) + 5
    assert result(repeat_report(twice)) == want
    lost = docs.union(spark.createDataFrame([(None, rows[0][1], *["x"] * 10)], docs.schema))
    assert {k: v[1] for k, v in result(repeat_report(lost)).items()}[None] == 0
    assert repeat_report(docs.limit(0)).count() == 0
    left = remove_repeats(docs)
    assert left.columns == docs.columns
    kept = {x.doc_id: x.text for x in left.collect()}
    for i, text in rows:
        n, gone, sha = want[i]
        if not gone:
            assert kept[i] == text
        else:
            assert hashlib.sha256(kept[i].encode()).hexdigest() == sha


def test_a_very_long_text_and_a_crowded_passage(spark):
    r = random.Random(11)
    run = lambda n: [r.choice("abcdef") + str(r.randrange(3000)) for _ in range(n)]
    passage, long = run(60), run(60_000)
    rows = [(i, " ".join(run(12) + passage + run(12))) for i in range(2_500)]
    rows += [(5_000, " ".join(long)), (5_001, " ".join(run(100) + long[20_000:50_000])), (4_999, " ".join(long[59_000:]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain(rows)
    assert want[5_000][1] == 1_000 and want[5_001][1] == 30_000 and want[7][1] >= 60
    for params in (RepeatParams(), RepeatParams(max_group=500, words_per_shard=20_000)):
        assert result(repeat_report(docs, params)) == want

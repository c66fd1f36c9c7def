import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from gridloom.llm.simhash import connected, fingerprints, keep_first, links, near_duplicates

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(rows):
    fps = {i: plain(t) for i, t in rows}
    root = {i: i for i in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(fps)
    for a in ids:
        for b in ids:
            if a < b and bin(fps[a] ^ fps[b]).count("1") <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (fps[i], find(i)) for i in ids}


def test_matches_brute_force(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text", "lang")
    want = plain_components([(r.doc_id, r.text) for r in docs.collect()])
    got = {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in near_duplicates(docs).collect()}
    assert got == want


def test_edges_of_input(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "Ab"), (5, "aB"), (6, "x y"), (7, "same words in here"), (7, "same words in here"), (8, "é É ü")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash")).withColumn("root", F.lit(1))
    got = [(r.doc_id, r.fp, r.component_id) for r in near_duplicates(docs).collect()]
    assert len(got) == len(rows)
    want = plain_components(dict(rows).items())
    assert {(i, f % (1 << 64), c) for i, f, c in got} == {(i, *v) for i, v in want.items()}
    assert near_duplicates(docs.limit(0)).count() == 0


def test_hot_blocks_link_as_pairs_do(spark):
    r = random.Random(5)
    base = [r.getrandbits(64) for _ in range(3)]
    fps = {b ^ sum(1 << r.randrange(64) for _ in range(r.randrange(7))) & ((1 << 64) - 1) for b in base for _ in range(120)}
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in fps]
    df = spark.createDataFrame(signed, "fp long")
    results = []
    for cap in (1, 8, 10_000):
        results.append({(x.node, x.root) for x in connected(links(df, cap)).collect()})
    assert results[0] == results[1] == results[2]
    assert results[0]


def test_long_chain_is_one_component(spark):
    edges = spark.range(1, 300).select(F.col("id").alias("u"), (F.col("id") - 1).alias("v"))
    got = connected(edges).collect()
    assert {x.root for x in got} == {0} and len(got) == 299


def test_unstable_components_are_not_returned(spark):
    edges = spark.range(1, 40).select(F.col("id").alias("u"), (F.col("id") - 1).alias("v"))
    with pytest.raises(RuntimeError, match="not stable after 1 rounds"):
        connected(edges, rounds=1)
    assert {x.root for x in connected(edges).collect()} == {0}


def test_one_row_of_a_group_stays(spark):
    words = lambda seed: " ".join(random.Random(f"{seed}{i}").choice("abcdefghij") * 3 + str(i) for i in range(80))
    a, b, c, d = (words(x) for x in "abcd")
    rows = [(1, a, "x"), (1, a, "x"), (1, a.upper(), "y"), (2, a, "x"), (None, a, "x"), (None, b, "x"), (None, b, "x"), (None, b, "y"), (2, c, "x"), (3, c, "x"), (None, d, "x"), (5, d, "x"), (6, None, "x"), (6, "", "x")]
    docs = spark.createDataFrame(rows * 3, "doc_id long, text string, source string").repartition(5)
    got = keep_first(docs).collect()
    assert sorted((r.doc_id or 0, (r.text or "").lower()) for r in got) == sorted([(1, a), (0, b), (2, c), (5, d), (6, "")])
    assert keep_first(docs).columns == docs.columns
    assert keep_first(docs.limit(0)).count() == 0


def test_a_very_long_text(spark):
    long = " ".join(f"w{i * i % 5003}" for i in range(80_000))
    rows = [(1, long), (2, long + " tail"), (3, long[: len(long) // 2]), (4, "x" * 500_000)]
    got = {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == plain_components(rows)

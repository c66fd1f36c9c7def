import hashlib
import random
import re
import struct

import xxhash
from pyspark.sql import functions as F

from gridloom.llm.winnow import WinnowParams, add_fingerprint, fingerprint_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")
P = WinnowParams()


def plain_positions(hashes, w):
    if not hashes:
        return []
    size = min(w, len(hashes))
    out = set()
    for at in range(len(hashes) - size + 1):
        window = hashes[at : at + size]
        low = min(window)
        out.add(at + max(i for i, h in enumerate(window) if h == low))
    return sorted(out)


def grams(text, k):
    words = [p for w in WORD.findall(text) for p in ([w[i : i + 16] for i in range(0, len(w), 16)] if len(w) > 64 else [w])]
    return [tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []


def check(spark, rows, params):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("part", F.lit("clash"))
    got = fingerprint_documents(docs, params).collect()
    assert len(got) == len(rows)
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (-(r[0] if r[0] is not None else -(1 << 63)), r[1]))
    want = []
    for at, (i, text) in enumerate(order):
        after = order[(at + 1) % len(order)][1]
        half = len(text) // 2
        want.append((i, len(text), hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()))
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted([(r.doc_id, r.n_chars, r.edited_sha256) for r in got], key=key) == sorted(want, key=key)
    prints = lambda text: [(h & 0xFFFFFFFF, at) for h, at in plain_prints(text, params)]
    line = lambda ps: " ".join(f"{h:08x}" for h, _ in ps)

    def near(a, b):
        a, b = {h for h, _ in a}, {h for h, _ in b}
        return len(a & b) / len(a | b) if a | b else 1.0

    full = []
    for at, (i, text) in enumerate(order):
        after = order[(at + 1) % len(order)][1]
        half = len(text) // 2
        one, edited, next_ = prints(text), prints(text[: len(text) - half] + after[:half]), prints(after)
        full.append((i, line(one), line(edited), near(one, edited), near(one, next_), [p for _, p in one]))
    rows_ = [(r.doc_id, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next, r.positions) for r in got]
    assert sorted(rows_, key=key) == sorted(full, key=key)
    return got


def test_neighbours_and_edits(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").collect()
    rows = [(r.doc_id * 3 % 1009, r.text) for r in docs] + [(5000, None), (5001, ""), (5002, "one"), (5003, "a b c d e f g"), (5004, "x" * 3000), (-7, "é\U0001f642 ü " * 50), (None, "null id")]
    for per_part in (5, 100_000):
        got = check(spark, rows, WinnowParams(rows_per_part=per_part))
    mean = lambda xs: sum(xs) / len(xs)
    long_ = [r for r in got if r.n_chars > 400]
    assert mean([r.near_edited for r in long_]) > 0.25 > mean([r.near_next for r in long_])
    check(spark, [(1, "alone in the world")], P)
    assert fingerprint_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_positions_are_winnowed(spark):
    r = random.Random(3)
    texts = [" ".join(r.choice("abc") for _ in range(r.randint(0, 60))) for _ in range(120)] + ["a " * 40, "z" * 200, "", "a b"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for params in (P, WinnowParams(gram=2, window=1), WinnowParams(gram=1, window=3)):
        got = {x.doc_id: [(p.hash, p.at) for p in x.prints] for x in add_fingerprint(df, "text", "prints", params).collect()}
        by_gram, hashes = {}, {}
        # The hash of each gram is read from the operator with windows of one, which keep everything.
        every = add_fingerprint(df, "text", "prints", WinnowParams(gram=params.gram, window=1)).collect()
        for x in every:
            g = grams(texts[x.doc_id], params.gram)
            assert [p.at for p in x.prints] == list(range(len(g)))
            hashes[x.doc_id] = [p.hash for p in x.prints]
            for a, b in zip(g, hashes[x.doc_id], strict=True):
                assert by_gram.setdefault(a, b) == b
        assert len(set(by_gram.values())) == len(by_gram)
        full = {i: [at for _, at in plain_prints(texts[i], params)] for i in got}
        for i, prints in got.items():
            assert [at for _, at in prints] == full[i]


def plain_prints(text, params):
    """(signed hash, position) of every kept gram, hashed as the DataFrame functions hash longs and strings."""

    def chain(longs):
        seed = 42
        for x in longs:
            seed = xxhash.xxh64_intdigest(struct.pack("<q", x), seed)
            seed = seed - (1 << 64) if seed >> 63 else seed
            seed &= (1 << 64) - 1
        return seed - (1 << 64) if seed >> 63 else seed

    def of_word(w):
        h = xxhash.xxh64_intdigest(w.encode(), 42)
        return h - (1 << 64) if h >> 63 else h

    hashes = [chain([of_word(w) for w in g]) for g in grams(text, params.gram)]
    return [(hashes[at], at) for at in plain_positions(hashes, params.window)]


def test_shared_runs_are_found(spark):
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    rows = []
    for i in range(40):
        run = [word() for _ in range(P.gram + P.window - 1)]
        for _ in range(2):
            rows.append((i, " ".join([word() for _ in range(r.randint(0, 40))] + run + [word() for _ in range(r.randint(0, 40))])))
    got = add_fingerprint(spark.createDataFrame(rows, "doc_id long, text string"), "text", "prints", P).collect()
    by = {}
    for x in got:
        by.setdefault(x.doc_id, []).append({p.hash for p in x.prints})
    assert all(a & b for a, b in by.values())

import random
import zlib
from itertools import combinations

from pyspark.sql import functions as F

from gridloom.llm.packing import best_buckets, pack, with_lengths
from gridloom.llm.sharding import shard_by_bytes
from gridloom.llm.urlrules import filter_urls, split_url


def plain_rule(host, path, rules):
    fit = [(len(h + p), h.count("."), h + p, a) for a, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[2:] if fit else (None, "allow")


def test_url_rules_both_ways_match_brute_force(spark):
    r = random.Random(1)
    label = lambda: r.choice(["a", "b", "net", "x-1", "É"])
    host = lambda n: ".".join(label() for _ in range(n))
    path = lambda n: "".join("/" + r.choice("pqr") for _ in range(n)) + r.choice(["", "/"])
    rules = list({(h, p): (r.choice(["allow", "block"]), h, p) for h, p in ((host(r.randint(1, 3)), path(r.randint(0, 2))) for _ in range(120))}.values())
    urls = [None, "", "no scheme", "://", "http://", "HTTP://A.Net?x", "http://a.net#f", "http://.net/", "http://É.b/p/"]
    urls += [f"http://{host(r.randint(1, 4)).upper()}{path(r.randint(0, 3))}{r.choice(['', '?q=/p', '#x'])}" for _ in range(600)] + ["https://a.a.net/p/q"] * 300
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit(1))
    want = {}
    for i, u in enumerate(urls):
        h, p = split_url(u)
        want[i] = (h, p, *plain_rule(h, p, rules))
    table = spark.createDataFrame(rules, "action string, host string, path string")
    for got in (filter_urls(pages, rules), filter_urls(pages, table), filter_urls(pages, table, max_local_rules=3, parts=7), filter_urls(pages, rules, max_local_rules=3, parts=2)):
        rows = got.collect()
        assert len(rows) == len(urls)
        assert {x.page_id: (x.host, x.path, x.rule, x.verdict) for x in rows} == want
    assert filter_urls(pages.limit(0), rules).count() == 0
    assert {x.verdict for x in filter_urls(pages, [], default="block").collect()} == {"block"}


def test_shards_match_brute_force(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(5000, None), (5001, ""), (5001, ""), (5002, "é" * 100_000), (None, "x")], "doc_id long, text string")
    docs = docs.union(odd).withColumn("size", F.lit("clash"))
    rows = sorted(((r.doc_id if r.doc_id is not None else -1, zlib.crc32((r.text or "").encode()), len((r.text or "").encode()) + 16) for r in docs.collect()))
    total, before, want, slots = sum(x[2] for x in rows), 0, [], {}
    for i, crc, size in rows:
        shard = min(39, (2 * before + size) * 40 // (2 * total))
        want.append((i, size, crc, shard, slots.setdefault(shard, 0)))
        slots[shard] += 1
        before += size
    for per_part in (7, 1_000_000):
        got = shard_by_bytes(docs, rows_per_part=per_part).collect()
        assert sorted((x.doc_id if x.doc_id is not None else -1, x.size, x.text_crc32, x.shard, x.slot) for x in got) == sorted(want)
    assert shard_by_bytes(docs.limit(0)).count() == 0


def padding(hist, edges):
    return sum(n * (min(e for e in edges if e >= k) - k) for k, n in hist.items())


def test_buckets_are_optimal():
    r = random.Random(2)
    for _ in range(200):
        hist = {r.randint(1, 60): r.randint(1, 50) for _ in range(r.randint(1, 9))}
        k = r.randint(1, 5)
        ls = sorted(hist)
        best = min(padding(hist, [*c, ls[-1]]) for m in range(k) for c in combinations(ls[:-1], min(m, len(ls) - 1)))
        edges = best_buckets(hist, k)
        assert len(edges) <= k and edges[-1] == ls[-1] and padding(hist, edges) == best
    assert best_buckets({}, 3) == []


def test_packing_is_whole(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(5000, None), (5001, ""), (5001, ""), (5002, "w " * 9_000), (None, "x")], "doc_id long, text string")
    docs = docs.union(odd).withColumn("batch", F.lit("clash"))
    n = docs.count()
    for per_part, lengths in ((9, 50_000), (1_000_000, 100)):
        rows = pack(with_lengths(docs), budget=4096, rows_per_part=per_part, max_lengths=lengths).collect()
        assert len(rows) == n and all(r.padding >= 0 and r.width == r.length + r.padding for r in rows)
        batches = {}
        for r in rows:
            batches.setdefault(r.batch, []).append(r)
        assert sorted(batches) == list(range(len(batches)))
        for b in batches.values():
            assert len({(r.bucket, r.width) for r in b}) == 1
            assert sorted(r.slot for r in b) == list(range(len(b)))
            assert len(b) * b[0].width <= 4096 or len(b) == 1
    want = {r.doc_id: len((r.text or "").split()) + 1 for r in docs.collect()}
    assert {r.doc_id: r.length for r in rows} == want
    assert pack(with_lengths(docs.limit(0))).count() == 0


def test_one_long_document_leaves_the_boundaries_optimal(spark):
    r = random.Random(3)
    lengths = [r.randint(1, 400) for _ in range(60)] + [201] * 20 + [5_000_000]
    hist = {k: lengths.count(k) for k in lengths}
    ls = sorted(hist)
    best = min(padding(hist, [*c, ls[-1]]) for c in combinations(ls[:-1], 2))
    docs = spark.createDataFrame(list(enumerate(lengths)), "doc_id long, n_words long")
    for most in (50_000, 10):
        rows = pack(docs, buckets=3, max_lengths=most).collect()
        assert sorted(x.length for x in rows) == sorted(lengths)
        assert sum(x.padding for x in rows) == best
        assert {x.width for x in rows} <= set(lengths)


def test_packing_matches_brute_force(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(7000, None), (7001, ""), (7002, "w " * 9_000), (None, "x")], "doc_id long, text string")
    docs = docs.union(odd)
    rows = sorted((r.doc_id is not None, r.doc_id or 0, len((r.text or "").split()) + 1, r.text) for r in docs.collect())
    hist = {}
    for _, _, n, _ in rows:
        hist[n] = hist.get(n, 0) + 1
    edges = best_buckets(hist, 8)
    want, first = [], 0
    for b, width in enumerate(edges):
        inside = [r for r in rows if (edges[b - 1] if b else 0) < r[2] <= width]
        size = max(1, 4096 // width)
        for i, (known, doc, n, text) in enumerate(inside):
            want.append((doc if known else None, text, n, b, width, first + i // size, i % size, width - n))
        first += -(-len(inside) // size)
    sized = spark.createDataFrame([(doc if known else None, n, text) for known, doc, n, text in rows], "doc_id long, n_words long, text string")
    plain = sorted((r.doc_id if r.doc_id is not None else -1, r.n_words) for r in with_lengths(docs).collect())
    assert plain == sorted((doc if known else -1, n) for known, doc, n, _ in rows)
    for per_part in (11, 100_000):
        got = pack(sized, budget=4096, rows_per_part=per_part, keep=("text",))
        assert got.columns == ["doc_id", "text", "length", "bucket", "width", "batch", "slot", "padding"]
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)

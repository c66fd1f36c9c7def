import hashlib

import duckdb
import numpy as np
from pyspark.sql import functions as F

from gridloom.operators import merge as R
from gridloom.plans import queries_chains as Q
from gridloom.plans import queries_tables as T


def test_merging_takes_all_links(spark, tiny):
    customers = {r.c_custkey: r.c_nationkey for r in spark.read.parquet(f"{tiny}/customer.parquet").collect()}
    orders = spark.read.parquet(f"{tiny}/orders.parquet").select("o_custkey", F.year("o_orderdate").alias("year"), "o_orderkey").collect()
    links = {}
    for r in orders:
        years = links.setdefault(str(r.o_custkey), {})
        years[r.year] = min(years.get(r.year, r.o_orderkey), r.o_orderkey)
    merged = {}
    for r in Q.chain_merge_fixpoint(spark, tiny).collect():
        merged.setdefault((r.chapter_id, r.chain_id), (r.sources.split(","), {}))[1][r.year] = r.table_id
    assert sorted(c for sources, _ in merged.values() for c in sources) == sorted(links)
    for sources, found in merged.values():
        assert set(found) == {y for c in sources for y in links[c]}
        assert all(t in {links[c].get(y) for c in sources} for y, t in found.items())
    for r in Q.merge_report(spark, tiny).collect():
        inside = [links[str(c)] for c, n in customers.items() if n == r.chapter_id and str(c) in links]
        assert (r.chains_before, r.years_before) == (len(inside), len({y for years in inside for y in years}))
        assert r.years_kept


def test_fallback_embeddings_are_whole(spark, tiny):
    rows = Q.fallback_embeddings(spark, tiny).collect()
    assert len(rows) == spark.read.parquet(f"{tiny}/part.parquet").count()
    for r in rows:
        seed = int(hashlib.md5(r.p_name.encode()).hexdigest()[:8], 16) % 10_000
        assert np.array_equal(np.array(r.embedding, np.float32), np.random.RandomState(seed).randn(768).astype(np.float32))


def test_representative_header_follows_its_sql(spark, tmp_path):
    texts = ["100\nx1\n20\n7", " a \n a　\n\tb\n\r", "0\n1\n0", "0", "", " \n ", None, "one\n\n one\ntwo0\nthree1\nfour2", "x" * 300 + "0"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    with duckdb.connect() as c:
        c.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        want = dict(c.execute(T.ORACLE_SQL["representative_header"]).fetchall())
    assert dict(map(tuple, T.representative_header(spark, str(tmp_path)).collect())) == want


def test_merge_report_of_a_large_block(spark):
    """30,000 chains of one block; its pairs would be 450 million."""
    years = F.explode(F.filter(F.sequence(F.lit(1992), F.lit(1998)), lambda y: F.pmod(F.hash("id", y), F.lit(5)) < 3))
    links = spark.range(30_000).select(F.lit(1).alias("chapter_id"), F.col("id").cast("string").alias("chain_id"), years.alias("year"), F.col("id").alias("table_id"))
    merged = R.merge_all(links).cache()
    report, before = R.merge_report(links, merged).first(), links.select("chain_id").distinct().count()
    assert (report.chains_before, report.years_before, report.years_kept) == (before, 7, True) and report.chains_after < 0.6 * before
    assert merged.select("chain_id", F.explode(F.split("sources", ",")).alias("s")).distinct().agg(F.count("*"), F.countDistinct("s")).first() == (before, before)

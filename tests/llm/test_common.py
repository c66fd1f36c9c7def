from pyspark.sql import functions as F

from gridloom.llm.common import BATCH_BYTES, by_counted_key, map_batches, spare

BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_batches_are_bounded_whatever_the_setting_looks_like(spark):
    before = spark.conf.get(BATCH)
    same = lambda batches: batches
    try:
        for value, after in (("64m", str(BATCH_BYTES)), (str(1 << 30), str(BATCH_BYTES)), ("1000b", "1000b"), ("2k", "2k")):
            spark.conf.set(BATCH, value)
            assert map_batches(spark.range(5), same, "id long").count() == 5
            assert spark.conf.get(BATCH) == after
    finally:
        spark.conf.set(BATCH, before)


def test_frequent_keys_join_as_others_do(spark):
    rows = spark.range(6_000).withColumn("k", F.when(F.col("id") < 2_500, F.lit(0)).otherwise(F.col("id") % 1_700))
    counts = rows.groupBy("k").agg(F.count("*").alias("many")).filter("many > 1")
    got = by_counted_key(rows, counts, ["k"], 6_000)
    want = rows.join(counts, "k")
    assert sorted(map(tuple, got.select("id", "k", "many").collect())) == sorted(map(tuple, want.select("id", "k", "many").collect()))
    assert counts.filter("many > 1000").count() == 1


def test_spare_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "_id int, _ID_ int, x int")
    assert spare(df, "_id", "_id", "y") == ["_id__", "_id___", "y"]

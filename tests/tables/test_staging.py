import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from gridloom.staging import CLEANUP, discard, shared_folder, stage


def test_a_cluster_needs_a_shared_folder():
    unset = SimpleNamespace(get=lambda name, default=None: default)
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(SimpleNamespace(conf=unset, sparkContext=context))


def test_stage_and_discard(spark):
    before = spark.conf.get(CLEANUP, None)
    df = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
    out = stage(df, "staged")
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, df.collect()))
    assert spark.conf.get(CLEANUP, None) == before
    path = out._staged_path.removeprefix("file:")
    assert os.path.isdir(path)
    discard(out, df)
    assert not os.path.exists(path)

"""Shared scratch on a cluster, replayed micro-batches, odd names and cells."""

import pytest
from pyspark.sql import functions as F

from pitwall.functions.timeparse import text_to_seconds
from pitwall.operators.race import named
from pitwall.session import checkpoint_dir, is_local


def test_a_cluster_needs_a_shared_folder(spark):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())
    assert is_local("local[4]") and not is_local("local-cluster[2,1,1024]")


def test_odd_minutes_are_numbers_or_null(spark):
    rows = spark.createDataFrame([("40000000:00",), ("99999999999999999999:1",), ("1:30",)], "t string")
    assert [r[0] for r in rows.select(text_to_seconds("t")).collect()] == [2.4e9, None, 90.0]


def test_compound_names_with_dots(spark):
    df = spark.createDataFrame([(1,)], "`_n_c3.5` int")
    assert df.agg(F.sum(named("_n_c3.5")).alias("n")).first().n == 1

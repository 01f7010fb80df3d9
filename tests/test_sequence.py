"""Dense rising keys, no single-partition window."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.sequence import assign_sequence


def test_dense_in_order(spark):
    df = spark.range(0, 5000, 3).repartition(7).select((F.col("id") * 7 % 10007).alias("k"))
    out = assign_sequence(df, ["k"], 100, "key", num_partitions=6)
    rows = sorted((r.k, r.key) for r in out.collect())
    assert [key for _, key in rows] == list(range(101, 101 + len(rows)))


def test_empty(spark):
    df = spark.createDataFrame([], "k long")
    assert assign_sequence(df, ["k"], 0, "key").count() == 0


def test_int4_overflow_raises(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    with pytest.raises(OverflowError):
        assign_sequence(df, ["k"], 2**31 - 5, "key", T.IntegerType())


def test_no_global_window(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    plan = assign_sequence(df, ["k"], 0, "key")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan

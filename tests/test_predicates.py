"""F2 / F3 / null-safe: the truth table of one text attribute."""

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.predicates import change_predicate

# (old, new) -> (padded, hash, nullsafe)
TRUTH = [
    (("a", "b"), (True, True, True)),
    (("a", None), (False, False, True)),
    ((None, "b"), (True, False, True)),
    ((None, ""), (False, False, True)),
    (("", None), (False, False, True)),
    ((None, None), (False, False, False)),
    (("a", "a"), (False, False, False)),
]


@pytest.mark.parametrize("rule,idx", [("padded", 0), ("hash", 1), ("nullsafe", 2)])
def test_truth_table(spark, rule, idx):
    df = spark.createDataFrame([o_n for o_n, _ in TRUTH], "old string, new string")
    pred = change_predicate(rule, [(F.col("old"), F.col("new"), "text")])
    got = [bool(r.c) for r in df.select(F.coalesce(pred, F.lit(False)).alias("c")).collect()]
    assert got == [exp[idx] for _, exp in TRUTH]


def test_money_pad_zero(spark):
    df = spark.createDataFrame([(None, "0.00"), (None, "1.00")], "old string, new string") \
        .select(F.col("old").cast("decimal(10,2)").alias("old"),
                F.col("new").cast("decimal(10,2)").alias("new"))
    pred = change_predicate("padded", [(F.col("old"), F.col("new"), "money")])
    assert [r.c for r in df.select(pred.alias("c")).collect()] == [False, True]


def test_decimal_values_not_text(spark):
    """Stored decimal(10,2) vs staged decimal(38,9): equal values are unchanged;
    a third decimal is a change on every run."""
    df = spark.createDataFrame([("999.99", "999.99"), ("999.99", "999.991")], "o string, n string") \
        .select(F.col("o").cast("decimal(10,2)").alias("old"),
                F.col("n").cast("decimal(38,9)").alias("new"))
    pred = change_predicate("hash", [(F.col("old"), F.col("new"), "money")])
    assert [r.c for r in df.select(pred.alias("c")).collect()] == [False, True]

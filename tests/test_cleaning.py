"""S3: boundary values of the cleaning rule."""

import pytest

from ledgerline.functions.cleaning import clean_values

CASES = [
    ("\\N", None), ("999.99", "999"), ("007", "7"), ("1.", "1"), (".5", "0"),
    ("-5", "-5"), (".", "."), ("1.2.3", "1.2.3"), ("", ""),
    ("2023-10-01 10:00:00", "2023-10-01 10:00:00"),
    ("9007199254740993", "9007199254740992"), ("abc", "abc"), ("12", "12"),
]


def test_clean_boundaries(spark):
    df = spark.createDataFrame([(v,) for v, _ in CASES], "v string")
    got = [r.v for r in clean_values(df).collect()]
    assert got == [e for _, e in CASES]


def test_reader_null_kept_empty(spark):
    df = spark.createDataFrame([(None,), ("\\N",)], "v string")
    assert [r.v for r in clean_values(df).collect()] == ["", None]
    assert [r.v for r in clean_values(df, keep_empty=False).collect()] == [None, None]


def test_no_truncate_keeps_decimals(spark):
    df = spark.createDataFrame([("999.99",), ("\\N",)], "v string")
    assert [r.v for r in clean_values(df, truncate=False).collect()] == ["999.99", None]


def test_beyond_bigint_raises(spark):
    df = spark.createDataFrame([("99999999999999999999999",)], "v string")
    with pytest.raises(Exception):
        clean_values(df).collect()


def test_cleaning_is_builtin_only(spark):
    df = spark.createDataFrame([("1",)], "v string")
    plan = clean_values(df)._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan

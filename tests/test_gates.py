"""C1-C4, K9, A1."""

import pytest

from ledgerline.operators import gates as G


def test_not_null_raises(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "id int, v string")
    with pytest.raises(G.GateError):
        G.require_not_null(df, ["id"])
    G.require_not_null(df, ["v"])


def test_unique_raises(spark):
    df = spark.createDataFrame([(1,), (2,), (2,)], "id int")
    with pytest.raises(G.GateError):
        G.require_unique(df, ["id"])
    G.require_unique(df.distinct(), ["id"])


def test_empty_raises(spark):
    with pytest.raises(G.GateError):
        G.require_rows(spark.createDataFrame([], "id int"))


def test_single_active(spark):
    df = spark.createDataFrame([(1, True), (1, False), (1, True)], "id int, is_active boolean")
    with pytest.raises(G.GateError):
        G.require_single_active(df, ["id"])


def test_constraint_report(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,), (3,), (3,), (3,)], "id int")
    r = G.constraint_report({"t": (df, ["id"])}).first()
    assert (r.n_rows, r.n_null_keys, r.n_duplicate_keys, r.n_duplicate_rows) == (7, 1, 2, 5)


def test_row_counts(spark):
    a = spark.range(5)
    b = spark.range(0)
    got = {r.table_name: r.n for r in G.row_counts({"a": a, "b": b}).collect()}
    assert got == {"a": 5, "b": 0}


def test_salted_lookup_equals_plain_join(spark):
    """A hot customer (a third of the sales) split over salts gives the plain
    join's rows, for LEFT and INNER lookups."""
    from pyspark.sql import functions as F

    from ledgerline.operators.lookup import salted_join
    sales = spark.range(3000).select(
        F.col("id").alias("sale_id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50 + 100).alias("customer_id"))
    lk = spark.range(100, 140).select(F.col("id").alias("_lk"), (F.col("id") * 10).alias("key")) \
        .union(spark.createDataFrame([(7, 70)], "_lk long, key long"))
    for how in ("left", "inner"):
        plain = sales.join(lk, sales.customer_id == lk._lk, how).drop("_lk")
        salted = salted_join(sales, lk, "customer_id", "_lk", how, 100, ["sale_id"]).drop("_lk")
        a = sorted(tuple(r) for r in plain.collect())
        b = sorted(tuple(r) for r in salted.select(*plain.columns).collect())
        assert a == b and len(a) == (3000 if how == "left" else 1000 + 1600)


def test_max_length(spark):
    df = spark.createDataFrame([("abc",), ("abcdef",)], "name string")
    G.require_max_length(df, {"name": 6})
    with pytest.raises(G.GateError):
        G.require_max_length(df, {"name": 5})


def test_decimal_overflow_raises(spark):
    df = spark.createDataFrame([("123456789.99",)], "v string")
    with pytest.raises(Exception):
        df.selectExpr("CAST(v AS DECIMAL(10,2)) AS v").collect()


def test_batch_key_gate(spark):
    ok = spark.createDataFrame([(1,), (2,)], "id int")
    assert G.require_batch_key(ok, ["id"]) == 2
    for rows in ([], [(1,), (None,)], [(1,), (1,)]):
        with pytest.raises(G.GateError):
            G.require_batch_key(spark.createDataFrame(rows, "id int"), ["id"])

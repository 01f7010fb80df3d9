"""The two column policies of the fact merge."""

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import types as T

from ledgerline.operators.upsert import fact_schema, upsert, upsert_fact
from ledgerline.plans.profiles import GCP, PSQL

D1, D2 = datetime(2024, 1, 1, 13), datetime(2024, 1, 2, 13)


def staged(spark, profile, rows):
    sch = "id string, source_system string, sales_id {i}, customer_key {k}, product_key {k}, " \
          "store_key {k}, sale_time timestamp_ntz, sale_date_key date, quantity {i}, " \
          "total_amount decimal(10,2), updated_at timestamp_ntz, dwh_load_date timestamp_ntz"
    i = profile.id_type.simpleString()
    k = profile.dim_key_type.simpleString()
    return spark.createDataFrame(rows, sch.format(i=i, k=k))


def row(profile, sid, key, when, qty):
    k = key if profile.name == "psql" else str(key)
    return (f"{profile.source_system}_{sid}", profile.source_system, sid, k, k, k, when,
            when.date(), qty, Decimal("1.50"), when, datetime(2024, 1, 9))


def test_psql_keeps_sale_date_key(spark):
    empty = spark.createDataFrame([], fact_schema(PSQL))
    f1 = upsert_fact(empty, staged(spark, PSQL, [row(PSQL, 1, 1, D1, 1), row(PSQL, 2, 1, D1, 1)]),
                     PSQL, "2024-01-01 03:00:00")
    f1 = spark.createDataFrame(f1.collect(), fact_schema(PSQL))
    f2 = upsert_fact(f1, staged(spark, PSQL, [row(PSQL, 2, 7, D2, 5), row(PSQL, 3, 7, D2, 1)]),
                     PSQL, "2024-01-02 03:00:00")
    got = {r.id: r for r in f2.collect()}
    assert len(got) == 3
    assert got["emea_2"].quantity == 5 and got["emea_2"].customer_key == 7
    assert got["emea_2"].sale_time == D2 and got["emea_2"].sale_date_key == date(2024, 1, 1)
    assert sorted(r.sales_key for r in got.values()) == [1, 2, 3]
    assert got["emea_2"].sales_key == 2 and got["emea_2"].created_at is None


def test_gcp_moves_sale_date_key(spark):
    empty = spark.createDataFrame([], fact_schema(GCP))
    s1 = staged(spark, GCP, [row(GCP, 1, 1, D1, 1)]).withColumn("created_at", __import__("pyspark.sql.functions", fromlist=["lit"]).lit(D1))
    f1 = spark.createDataFrame(upsert_fact(empty, s1, GCP, "2024-01-01 03:00:00").collect(),
                               fact_schema(GCP))
    s2 = staged(spark, GCP, [row(GCP, 1, 9, D2, 4), row(GCP, 5, 9, D2, 1)])
    got = {r.id: r for r in upsert_fact(f1, s2, GCP, "2024-01-02 03:00:00").collect()}
    assert got["global_1"].sale_date_key == date(2024, 1, 2)
    assert got["global_1"].sales_key == "1704078000_global_1"  # kept from day 1
    assert got["global_5"].sales_key == "1704164400_global_5"
    assert got["global_1"].created_at is None  # staged, never inserted


def test_held_keys_are_not_looked_up_again(spark):
    schema = "k long, id string, v long"
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, None, 1)], schema)
    source = spark.createDataFrame([("b", 2), ("c", 2), (None, 2)], "id string, v long")
    args = (target, source, "id", ("v",), ("id", "v"), "k", "sequence", "2024-01-01 00:00:00", target.schema)
    plain = upsert(*args, key_start=3)
    given = upsert(*args, key_start=3, held=spark.createDataFrame([("b",)], "id string"))
    assert sorted(map(str, plain.collect())) == sorted(map(str, given.collect()))
    assert given.count() == 5
    epoch = (*args[:6], "epoch", *args[7:8], T.StructType([T.StructField("k", T.StringType()), *target.schema.fields[1:]]))
    joins = [upsert(*epoch, **kw)._jdf.queryExecution().analyzed().toString().count("Join ") for kw in ({}, {"held": spark.createDataFrame([("b",)], "id string")})]
    assert joins[1] == joins[0] - 1

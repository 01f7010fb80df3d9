"""Retail source tables derived from the TPC-H style test parquet.

The test data has no retail CSVs, so the four source tables are views over
it (see FIXTURES.md). Batches b1/b2/b3 are derived from the data by key
arithmetic, so Spark and the SQL oracle build the very same inputs. Every
row of the underlying tables is read; the arithmetic only decides what each
simulated day looks like.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.timestamps import ts_literal
from ledgerline.plans.profiles import Profile


@dataclass(frozen=True)
class Run:
    """One simulated day: batch name, run time and folder stamp."""

    batch: str
    run_ts: str
    stamp: str


# The simulated runs and the source time stamps.
RUNS = {
    "b1": Run("b1", "2024-01-01 03:00:00", "20240101030000"),
    "b2": Run("b2", "2024-01-02 03:00:00", "20240102030000"),
    "b3": Run("b3", "2024-01-03 03:00:00", "20240103030000"),
}
SOURCE_TS = "2024-01-01 00:00:00"
TOUCHED_TS = "2024-01-03 00:00:00"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _base(spark: SparkSession, sf_dir: str, table: str, profile: Profile) -> DataFrame:
    """Day-0 source rows: (k, name, attr[, price])."""
    if table == "customers":
        df = read_table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("k"), F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("attr"))
    elif table == "products":
        df = read_table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("k"), F.col("p_name").alias("name"),
            F.col("p_type").alias("attr"),
            F.col("p_retailprice").cast(profile.money_type).alias("price"))
    elif table == "stores":
        df = read_table(spark, sf_dir, "supplier").select(
            F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"),
            F.col("s_nationkey").cast("string").alias("attr"))
    else:
        raise ValueError(f"not a dimension source: {table}")
    return df


_ATTR_NAMES = {"customers": ("customer_id", "name", "address"),
               "products": ("product_id", "name", "category"),
               "stores": ("store_id", "name", "location")}


def _batch_rule(batch: str, k: Column, name: Column, attr: Column):
    """(row filter, name, attr, updated_at) for one batch."""
    null_s = F.lit(None).cast("string")
    src_ts = ts_literal(SOURCE_TS)
    if batch == "b1":
        return (k % 10 != 0, name, F.when(k % 11 == 0, null_s).otherwise(attr), src_ts)
    name2 = F.when(k % 5 == 1, F.concat(name, F.lit("!"))).otherwise(name)
    attr2 = (F.when(k % 13 == 0, null_s).when(k % 7 == 0, F.lit("MOVED")).otherwise(attr))
    if batch == "b2":
        return (F.lit(True), name2, attr2, src_ts)
    if batch == "b3":
        attr3 = F.when(k % 7 == 0, F.lit("MOVED AGAIN")).otherwise(attr2)
        upd3 = F.when(k % 3 == 0, ts_literal(TOUCHED_TS)).otherwise(src_ts)
        return (k % 17 != 0, name2, attr3, upd3)
    raise ValueError(f"unknown batch {batch}")


def dimension_source(spark: SparkSession, sf_dir: str, table: str, batch: str,
                     profile: Profile) -> DataFrame:
    """customers / products / stores as delivered in ``batch``."""
    base = _base(spark, sf_dir, table, profile)
    keep, name, attr, upd = _batch_rule(batch, F.col("k"), F.col("name"), F.col("attr"))
    id_col, name_col, attr_col = _ATTR_NAMES[table]
    cols = [F.col("k").cast(profile.id_type).alias(id_col), name.alias(name_col),
            attr.alias(attr_col)]
    if table == "products":
        cols.append(F.col("price"))
    cols += [ts_literal(SOURCE_TS).alias("created_at"), upd.alias("updated_at")]
    return base.filter(keep).select(*cols)


def sales_all(spark: SparkSession, sf_dir: str, profile: Profile) -> DataFrame:
    """One sale per order that has lines: lines pre-aggregated per order.

    The line aggregate is partial (map-side) and leaves the data hash
    partitioned by order key, which the join with orders reuses.
    """
    lines = (read_table(spark, sf_dir, "lineitem")
             .groupBy("l_orderkey")
             .agg(F.min("l_partkey").alias("product_id"),
                  F.min("l_suppkey").alias("store_id"),
                  F.sum("l_quantity").alias("qty")))
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    joined = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "inner")
    return joined.select(
        F.col("o_orderkey").cast(profile.id_type).alias("sale_id"),
        F.col("o_custkey").cast(profile.id_type).alias("customer_id"),
        F.col("product_id").cast(profile.id_type).alias("product_id"),
        F.col("store_id").cast(profile.id_type).alias("store_id"),
        F.col("o_orderdate").alias("sale_date"),
        F.col("qty").cast("int").cast(profile.id_type).alias("quantity"),
        F.col("o_totalprice").cast("decimal(10,2)").cast(profile.money_type)
        .alias("total_amount"),
        ts_literal(SOURCE_TS).alias("created_at"),
        ts_literal(SOURCE_TS).alias("updated_at"),
    )


def sales_source(spark: SparkSession, sf_dir: str, batch: str, profile: Profile) -> DataFrame:
    """Sales batch: day 1 has sale_id % 4 <> 0; day 2 has all others, and
    re-sends sale_id % 3 = 0. All of day 2 has quantity + 1 and, where
    sale_id % 6 = 0, the sale one day later. "all": every sale as it is."""
    if batch == "all":
        return sales_all(spark, sf_dir, profile)
    s = sales_all(spark, sf_dir, profile)
    if batch == "b1":
        return s.filter(F.col("sale_id") % 4 != 0)
    if batch == "b2":
        sid = F.col("sale_id")
        return (s.filter((sid % 3 == 0) | (sid % 4 == 0))
                .withColumn("sale_date", F.when(sid % 6 == 0, F.col("sale_date") + F.expr("INTERVAL 1 DAY"))
                            .otherwise(F.col("sale_date")))
                .withColumn("quantity", (F.col("quantity") + 1).cast(profile.id_type))
                .withColumn("updated_at", ts_literal("2024-01-02 00:00:00")))
    raise ValueError(f"unknown sales batch {batch}")

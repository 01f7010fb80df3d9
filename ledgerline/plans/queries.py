"""Registered queries: one per operator group of the inventory.

Each takes (spark, sf_dir) and returns a DataFrame over the whole test
tables. ``ledgerline.plans.oracle`` holds the matching DuckDB SQL.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.cleaning import clean_values
from ledgerline.functions.keys import hash_key
from ledgerline.functions.predicates import changed_hash, rounded
from ledgerline.functions.timestamps import ts_literal
from ledgerline.operators.gates import constraint_report, row_counts
from ledgerline.operators.scd2 import changed_rows, dim_schema, new_versions, versions_to_open
from ledgerline.operators.sequence import assign_sequence, max_key
from ledgerline.operators.zorder import curve
from ledgerline.plans.daily_runs import (all_dimensions_after, dimension_after, fact_after,
                                       staged_dimension, staged_fact)
from ledgerline.plans.profiles import CUSTOMER, DIMENSIONS, GCP, PSQL, PSQL_LENGTHS, with_rule
from ledgerline.plans.jobs import SCHEMAS, dim_table, job_gcp, job_load_csv_registry, job_warehouse, load_dimension, read_fact
from ledgerline.plans.sql import run_statement
from ledgerline.plans.tables import Warehouse, in_layout
from ledgerline.session import materialize, scratch_root
from ledgerline.sources.csv import read_csv_by_name
from ledgerline.sources.landing import batch_view, land_files
from ledgerline.sources.quarantine import REASONS, accepted, judged, rejected
from ledgerline.sources.retail import RUNS, SOURCE_TS, dimension_source, read_table, sales_all, sales_source
from ledgerline.sources.schemas import source_schema

Query = Callable[[SparkSession, str], DataFrame]


def _stage(dim_name: str, profile) -> Query:
    return lambda spark, sf: staged_dimension(spark, sf, DIMENSIONS[dim_name], profile, "b2")


def _scd2(dim_name: str, profile, batches=("b1", "b2"), shuffle: bool = False) -> Query:
    return lambda spark, sf: dimension_after(spark, sf, DIMENSIONS[dim_name], profile, batches,
                                             shuffle=shuffle)


def _changed(profile) -> Query:
    def q(spark, sf):
        dim1 = dimension_after(spark, sf, CUSTOMER, profile, ("b1",))
        stage2 = staged_dimension(spark, sf, CUSTOMER, profile, "b2")
        return changed_rows(stage2, dim1, CUSTOMER, profile).select(
            "id", F.col("_hit").alias("has_active"), F.col("_changed").alias("changed"))
    return q


def carry_forward_psql(spark: SparkSession, sf: str) -> DataFrame:
    """Versions opened by b2 (psql): NULL text attributes carried forward."""
    dim1 = dimension_after(spark, sf, CUSTOMER, PSQL, ("b1",))
    stage2 = staged_dimension(spark, sf, CUSTOMER, PSQL, "b2")
    opened = versions_to_open(changed_rows(stage2, dim1, CUSTOMER, PSQL))
    run = RUNS["b2"]
    return new_versions(opened, CUSTOMER, PSQL, run.run_ts, run.stamp, dim=dim1)


def clean_values_query(spark: SparkSession, sf: str) -> DataFrame:
    """S3 over text built from every line item (digits, dots, signs, NULL marker)."""
    li = read_table(spark, sf, "lineitem")
    s = lambda c: F.col(c).cast("string")
    raw = li.select(
        "l_orderkey", "l_linenumber",
        F.col("l_quantity").cast("decimal(10,2)").cast("string").alias("v_qty"),
        F.col("l_extendedprice").cast("decimal(12,2)").cast("string").alias("v_price"),
        F.lpad(s("l_linenumber"), 3, "0").alias("v_padded"),
        F.concat(F.lit("."), s("l_linenumber")).alias("v_dot_first"),
        F.concat(s("l_orderkey"), F.lit(".")).alias("v_dot_last"),
        F.concat(F.lit("-"), s("l_partkey")).alias("v_negative"),
        F.concat_ws(".", s("l_orderkey"), s("l_linenumber"), s("l_suppkey")).alias("v_two_dots"),
        F.when(F.col("l_orderkey") % 9 == 0, F.lit("\\N")).otherwise(F.col("l_returnflag"))
        .alias("v_null_marker"),
        s("l_shipdate").alias("v_timestamp"),
        F.when(F.col("l_linenumber") % 2 == 0, F.lit("")).otherwise(F.lit(".")).alias("v_empty"),
        (F.col("l_orderkey") + F.lit(9007199254740000)).cast("string").alias("v_big"),
    )
    return clean_values(raw, [c for c in raw.columns if c.startswith("v_")])


def fact_stage(profile, shuffle: bool = False) -> Query:
    def q(spark, sf):
        dims = all_dimensions_after(spark, sf, profile, ("b1", "b2"), shuffle=shuffle)
        return staged_fact(spark, sf, profile, "b2", dims, shuffle=shuffle, sales_batch="all")
    return q


def fact_upsert(profile, shuffle: bool = False) -> Query:
    return lambda spark, sf: fact_after(spark, sf, profile, ("b1", "b2"), shuffle=shuffle)


def surrogate_sequence(spark: SparkSession, sf: str) -> DataFrame:
    """U1 over every order: dense keys after 1000 in order-key order."""
    orders = read_table(spark, sf, "orders").select("o_orderkey")
    return assign_sequence(orders, ["o_orderkey"], 1000, "seq_key")


def surrogate_hash(spark: SparkSession, sf: str) -> DataFrame:
    stage = staged_dimension(spark, sf, CUSTOMER, GCP, "b2")
    return stage.select("id", hash_key("id", RUNS["b2"].stamp).alias("customer_key"))


def row_count_gate(spark: SparkSession, sf: str) -> DataFrame:
    tables = {t: dimension_source(spark, sf, t, "b2", PSQL)
              for t in ("customers", "products", "stores")}
    tables["sales"] = sales_all(spark, sf, PSQL)
    return row_counts(tables)


def constraint_report_query(spark: SparkSession, sf: str) -> DataFrame:
    tables = {t: (dimension_source(spark, sf, t, "b2", PSQL), [DIMENSIONS[d].natural_id])
              for t, d in (("customers", "customer"), ("products", "product"),
                           ("stores", "store"))}
    tables["sales"] = (sales_all(spark, sf, PSQL), ["sale_id"])
    tables["lineitem"] = (read_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])
    return constraint_report(tables)


def _job(profile, table: str) -> Query:
    """W2 / W3 from the sources on: two daily loads written to a warehouse of
    their own in the shared folder, and ``table`` read back from it."""
    def q(spark, sf):
        run_id = uuid.uuid4().hex[:12]
        wh = Warehouse(spark, f"{scratch_root(spark)}/job-{run_id}", db_prefix=f"job{run_id}_")
        for batch in ("b1", "b2"):
            sources = {t: dimension_source(spark, sf, t, batch, profile) for t in ("customers", "products", "stores")}
            sources["sales"] = sales_source(spark, sf, batch, profile)
            job_warehouse(spark, wh, profile, sources, RUNS[batch].run_ts, RUNS[batch].stamp)
        if table == "fact_sales":
            return read_fact(wh, profile)
        return wh.read(f"{SCHEMAS[profile.name][2]}.{table}")
    return q


def _as_csv(df: DataFrame, null: str = "") -> str:
    path = f"{scratch_root(df.sparkSession)}/csv-{uuid.uuid4().hex}"
    df.write.option("header", True).option("escape", '"').option("nullValue", null).csv(path)
    return path


def csv_by_name_customers(spark: SparkSession, sf: str) -> DataFrame:
    """S1 + S3: all customers as CSV with the NULL marker, read by header name."""
    path = _as_csv(dimension_source(spark, sf, "customers", "b2", PSQL), "\\N")
    return read_csv_by_name(spark, path, source_schema("customers", PSQL))


def landed_products(spark: SparkSession, sf: str) -> DataFrame:
    """S2 + S6 + S7: all products as CSV, landed by copy, read by position."""
    root, stamp = f"{scratch_root(spark)}/landing-{uuid.uuid4().hex}", RUNS["b2"].stamp
    land_files(spark, {"products": _as_csv(dimension_source(spark, sf, "products", "b2", GCP))}, root, stamp)
    return batch_view(spark, root, stamp, "products", source_schema("products", GCP), view="landed_products_view")


def _stored(dim_name: str, profile) -> Query:
    """D1-D4 as stored: three batches into one dimension table, of which each
    run writes the touched partitions only."""
    def q(spark, sf):
        run_id = uuid.uuid4().hex[:12]
        wh = Warehouse(spark, f"{scratch_root(spark)}/stored-{run_id}", db_prefix=f"stored{run_id}_")
        wh.ensure_schemas(SCHEMAS[profile.name][2])
        spec = DIMENSIONS[dim_name]
        for batch in ("b1", "b2", "b3"):
            staged = staged_dimension(spark, sf, spec, profile, batch)
            load_dimension(wh, spec, profile, staged, RUNS[batch].run_ts, RUNS[batch].stamp, deep_gates=False)
        return wh.read(dim_table(spec, profile)).select(*dim_schema(spec, profile).names)
    return q


def typed_target_defaults(spark: SparkSession, sf: str) -> DataFrame:
    """K5 + K6: all customers inserted with a column list into a typed table;
    the columns left out are read back with their defaults."""
    run_id = uuid.uuid4().hex[:12]
    wh = Warehouse(spark, f"{scratch_root(spark)}/typed-{run_id}", db_prefix=f"typed{run_id}_")
    wh.ensure_schemas("dwh")
    schema = T.StructType([T.StructField("customer_id", T.LongType(), False), T.StructField("customer_name", T.StringType()),
                           T.StructField("is_active", T.BooleanType()), T.StructField("effective_start_date", T.TimestampNTZType()),
                           T.StructField("segment", T.StringType())])
    wh.create_table("dwh.customers", schema, ("segment",), {"customer_name": PSQL_LENGTHS["customer_name"]},
                    {"is_active": "true", "effective_start_date": f"TIMESTAMP_NTZ'{RUNS['b1'].run_ts}'"})
    rows = read_table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"), F.col("c_mktsegment").alias("segment"))
    wh.insert(rows, "dwh.customers")
    return wh.read("dwh.customers")


def quarantine_parts(spark: SparkSession, sf: str) -> DataFrame:
    """C5 with rejects as data: every part as text, some of it unfit, judged
    against a declared schema; accepted rows typed, rejected ones with reasons."""
    k = F.col("p_partkey")
    text = read_table(spark, sf, "part").select(
        k.cast("string").alias("product_id"),
        F.when(k % 17 == 0, F.repeat("p_name", 9)).otherwise(F.col("p_name")).alias("name"),
        F.when(k % 11 == 0, F.lit("n/a")).when(k % 13 == 0, F.lit("123456789012.5")).when(k % 19 == 0, F.lit(None))
        .otherwise(F.col("p_retailprice").cast("decimal(10,2)").cast("string")).alias("price"))
    schema = T.StructType([T.StructField("product_id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("price", T.DecimalType(10, 2))])
    rows = judged(text, schema, {"name": 100}, ["price"])
    good = accepted(rows, schema).select("product_id", F.lit(True).alias("kept"), "price", F.lit("").alias("reasons"))
    bad = rejected(rows).select(F.col("product_id").cast("long").alias("product_id"), F.lit(False).alias("kept"),
                                F.lit(None).cast("decimal(10,2)").alias("price"), F.array_join(REASONS, "; ").alias("reasons"))
    return good.unionByName(bad)


def scd2_customer_psql_sql(spark: SparkSession, sf: str) -> DataFrame:
    """The second day of the customer dimension from SQL files; only the
    sequence keys are assigned outside (without a one-task window)."""
    run, mark = RUNS["b2"], uuid.uuid4().hex[:12]
    dim1 = dimension_after(spark, sf, CUSTOMER, PSQL, ("b1",))
    views = {n: f"customer_{n}_{mark}" for n in ("dim", "stage", "opened")}
    dim1.createOrReplaceTempView(views["dim"])
    staged_dimension(spark, sf, CUSTOMER, PSQL, "b2").createOrReplaceTempView(views["stage"])
    opened = materialize(run_statement(spark, "customer_opened_psql", stage=views["stage"], dim=views["dim"], run_ts=run.run_ts))
    opened.createOrReplaceTempView(views["opened"])
    kept = run_statement(spark, "customer_kept_psql", dim=views["dim"], opened=views["opened"], run_ts=run.run_ts)
    added = assign_sequence(opened, ["customer_id"], max_key(dim1, "customer_key"), "customer_key", PSQL.dim_key_type)
    return kept.unionByName(added).select(*dim1.columns)


def changed_money_text(spark: SparkSession, sf: str) -> DataFrame:
    """Prices of three decimals against their stored rounding, as values, as
    values in the stored type, as text, and as text without added zeros."""
    price = F.col("p_retailprice").cast("decimal(10,2)")
    new = (price + F.when(F.col("p_partkey") % 3 == 0, F.lit(0.004).cast("decimal(4,3)")).when(F.col("p_partkey") % 5 == 0, F.lit(1).cast("decimal(4,3)"))
           .otherwise(F.lit(0).cast("decimal(4,3)"))).cast("decimal(38,9)")
    df = read_table(spark, sf, "part").select("p_partkey", price.alias("old"), new.alias("new"))
    pairs = [(F.col("old"), F.col("new"), "money")]
    return df.select("p_partkey", changed_hash(pairs).alias("by_value"), changed_hash(rounded(pairs, "decimal(10,2)")).alias("by_rounded"),
                     changed_hash(pairs, use_md5=True).alias("by_text"), changed_hash(pairs, use_md5=True, canonical=True).alias("by_canonical_text"),
                     changed_hash(rounded(pairs, "decimal(10,2)"), use_md5=True, canonical=True).alias("by_rounded_text"))


def csv_quoted_newlines(spark: SparkSession, sf: str) -> DataFrame:
    """All customers as CSV whose addresses hold line breaks and quotes,
    read by splits."""
    k = F.col("c_custkey")
    odd = read_table(spark, sf, "customer").select(
        k.cast("int").alias("customer_id"), F.col("c_name").alias("name"),
        F.when(k % 3 == 0, F.concat(F.col("c_mktsegment"), F.lit("\nfloor "), k.cast("string")))
        .when(k % 3 == 1, F.concat(F.lit('say "hi",\n'), F.col("c_mktsegment"), F.lit('\n"'))).otherwise(F.col("c_mktsegment")).alias("address"),
        ts_literal(SOURCE_TS).alias("created_at"), ts_literal(SOURCE_TS).alias("updated_at"))
    return read_csv_by_name(spark, _as_csv(odd), source_schema("customers", PSQL), multi_line=True)


def clustered_sales(spark: SparkSession, sf: str) -> DataFrame:
    """K8: every sale written along a Z-order curve of its four keys, read back."""
    df = sales_all(spark, sf, GCP)
    z = curve(df, ["sale_id", "customer_id", "product_id", "store_id"])
    path = f"{scratch_root(spark)}/clustered-{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    in_layout(df, n, z).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def w1_products(spark: SparkSession, sf: str) -> DataFrame:
    """W1 + S4: products as CSV, through the registry: read, cleaned (numbers cut
    to whole ones), counted, replaced, read back."""
    run_id = uuid.uuid4().hex[:12]
    folder = f"{scratch_root(spark)}/w1-{run_id}"
    wh = Warehouse(spark, f"{folder}/wh", db_prefix=f"w1{run_id}_")
    for t in ("customers", "products"):
        dimension_source(spark, sf, t, "b2", PSQL).write.option("header", True).option("escape", '"').option("nullValue", "\\N").csv(f"{folder}/{t}.csv")
    job_load_csv_registry(spark, wh, str(Path(__file__).parents[1] / "sources" / "retail.yaml"), folder)
    return wh.read("public.products")


def w3_fact_gcp(spark: SparkSession, sf: str) -> DataFrame:
    """W3 whole: two days of CSV files landed, bound by position, loaded."""
    run_id = uuid.uuid4().hex[:12]
    folder = f"{scratch_root(spark)}/w3-{run_id}"
    wh = Warehouse(spark, f"{folder}/wh", db_prefix=f"w3{run_id}_")
    for batch in ("b1", "b2"):
        sources = {t: dimension_source(spark, sf, t, batch, GCP) for t in ("customers", "products", "stores")}
        sources["sales"] = sales_source(spark, sf, batch, GCP)
        job_gcp(spark, wh, {t: _as_csv(df) for t, df in sources.items()}, f"{folder}/landing", datetime.strptime(RUNS[batch].stamp, "%Y%m%d%H%M%S"))
    return read_fact(wh, GCP)


def registry() -> dict[str, Query]:
    q: dict[str, Query] = {}
    for prof in (PSQL, GCP):
        for d in ("customer", "product"):
            q[f"stored_{d}_{prof.name}"] = _stored(d, prof)
    for f in (typed_target_defaults, quarantine_parts, scd2_customer_psql_sql, changed_money_text, csv_quoted_newlines,
              clustered_sales, w1_products, w3_fact_gcp):
        q[f.__name__] = f
    for prof in (PSQL, GCP):
        q[f"job_fact_{prof.name}"] = _job(prof, "fact_sales")
        q[f"job_customer_{prof.name}"] = _job(prof, "dim_customer")
    q["csv_by_name_customers"] = csv_by_name_customers
    q["landed_products"] = landed_products
    for prof in (PSQL, GCP):
        for d in ("customer", "product", "store"):
            q[f"stage_{d}s_{prof.name}"] = _stage(d, prof)
    q["clean_values"] = clean_values_query
    q["changed_psql"] = _changed(PSQL)
    q["changed_gcp"] = _changed(GCP)
    q["changed_nullsafe"] = _changed(with_rule(PSQL, "nullsafe"))
    for prof in (PSQL, GCP):
        for d in ("customer", "product", "store"):
            q[f"scd2_{d}_{prof.name}"] = _scd2(d, prof)
    q["scd2_customer_nullsafe"] = _scd2("customer", with_rule(PSQL, "nullsafe"))
    q["scd2_three_batches_psql"] = _scd2("customer", PSQL, ("b1", "b2", "b3"))
    q["scd2_three_batches_gcp"] = _scd2("customer", GCP, ("b1", "b2", "b3"))
    q["scd2_rerun_psql"] = _scd2("customer", PSQL, ("b1", "b2", "b2"))
    q["scd2_rerun_gcp"] = _scd2("customer", GCP, ("b1", "b2", "b2"))
    q["carry_forward_psql"] = carry_forward_psql
    q["fact_stage_psql"] = fact_stage(PSQL)
    q["fact_stage_gcp"] = fact_stage(GCP)
    q["fact_upsert_psql"] = fact_upsert(PSQL)
    q["fact_merge_gcp"] = fact_upsert(GCP)
    # the same results through the large-batch plans (shuffle joins, salted
    # hot-key lookups, full outer merge)
    q["scd2_customer_psql_shuffled"] = _scd2("customer", PSQL, shuffle=True)
    q["scd2_customer_gcp_shuffled"] = _scd2("customer", GCP, shuffle=True)
    q["fact_stage_psql_salted"] = fact_stage(PSQL, shuffle=True)
    q["fact_stage_gcp_salted"] = fact_stage(GCP, shuffle=True)
    q["fact_upsert_psql_shuffled"] = fact_upsert(PSQL, shuffle=True)
    q["fact_merge_gcp_shuffled"] = fact_upsert(GCP, shuffle=True)
    q["surrogate_sequence"] = surrogate_sequence
    q["surrogate_hash"] = surrogate_hash
    q["row_count_gate"] = row_count_gate
    q["constraint_report"] = constraint_report_query
    return q

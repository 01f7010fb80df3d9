"""Staging projections for dimensions and the fact.

Pure projections (no shuffle): they stay inside one whole-stage-codegen span
and are fused with the scan, so filters and column pruning reach parquet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.timestamps import parse_stamp, ts_literal
from ledgerline.plans.profiles import DimSpec, Profile


def business_id(source_system: str, natural_id: Column | str) -> Column:
    """``<system>_<id>``; NULL id gives NULL (``concat``)."""
    c = F.col(natural_id) if isinstance(natural_id, str) else natural_id
    return F.concat(F.lit(source_system), F.lit("_"), c.cast("string"))


def load_stamp(profile: Profile, run_ts: str, stamp: str | None) -> Column:
    """P5: psql stamps with the run's now; gcp parses the batch folder stamp."""
    if profile.name == "gcp" and stamp is not None:
        return parse_stamp(stamp)
    return ts_literal(run_ts)


def stage_dimension(src: DataFrame, dim: DimSpec, profile: Profile, run_ts: str,
                    stamp: str | None = None) -> DataFrame:
    cols = [business_id(profile.source_system, dim.natural_id).alias("id"),
            F.lit(profile.source_system).alias("source_system"),
            F.col(dim.natural_id).cast(profile.id_type).alias(dim.natural_id)]
    for a in dim.attrs:
        if a.kind == "money":
            if profile.staged_money_type != profile.money_type:
                # SAFE_CAST -> NULL when the value does not fit
                v = F.expr(f"try_cast(`{a.source}` AS {profile.staged_money_type.simpleString()})")
            else:
                v = F.col(a.source)
            cols.append(v.alias(a.target))
        else:
            cols.append(F.col(a.source).alias(a.target))
    cols.append(F.col("created_at"))
    if profile.writes_created:
        cols.append(F.to_date("created_at").alias("created_date"))  # P4 / X3
    cols += [F.col("updated_at"), load_stamp(profile, run_ts, stamp).alias("dwh_load_date")]
    return src.select(*cols)


def stage_sales(keyed: DataFrame, profile: Profile, run_ts: str,
                stamp: str | None = None) -> DataFrame:
    """Fact staging over sales that already carry the three dimension keys
    (see :func:`ledgerline.operators.lookup.lookup_keys`)."""
    amount = F.col("total_amount")
    if profile.staged_money_type != profile.money_type:
        amount = amount.cast(profile.staged_money_type)  # X5: raises on failure
    updated = F.col("sale_date") if profile.fact_updated_at_from_sale_date else F.col("updated_at")
    cols = [business_id(profile.source_system, "sale_id").alias("id"),
            F.lit(profile.source_system).alias("source_system"),
            F.col("sale_id").alias("sales_id"),
            F.col("customer_key"), F.col("product_key"), F.col("store_key"),
            F.col("sale_date").alias("sale_time"),
            F.to_date("sale_date").alias("sale_date_key"),
            F.col("quantity"),
            amount.alias("total_amount")]
    if profile.name == "gcp":
        cols.append(F.col("created_at"))
    cols += [updated.alias("updated_at"), load_stamp(profile, run_ts, stamp).alias("dwh_load_date")]
    return keyed.select(*cols)

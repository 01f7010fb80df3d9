"""Keyed upsert of the fact.

A left join of the target with the source, and an anti join for the new rows,
on the business id; per output column:

* key column: coalesce of both sides;
* update columns: the source value when the source row is there;
* other insert columns: the target value when the target row is there,
  else the source value;
* columns never inserted (created_at, created_date): target value or NULL;
* surrogate key: the target's when matched; new rows get a fresh one
  (``epoch``: ``<unix seconds>_<id>``; ``sequence``: dense after the max).

"Matched" is read from literal marker columns on each side, never from key
NULL-ness. A duplicate key in the source must be rejected before this
(``gates.require_unique``), as the merge statements would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.keys import epoch_key
from ledgerline.operators.sequence import KeySequence, assign_sequence, next_start
from ledgerline.plans.profiles import Profile

FACT_INSERT_COLS = ("sales_id", "id", "source_system", "customer_key", "product_key",
                    "store_key", "sale_time", "sale_date_key", "quantity", "total_amount",
                    "updated_at", "dwh_load_date")


def fact_schema(profile: Profile) -> T.StructType:
    """K5: typed fact table."""
    key = profile.dim_key_type
    f = [T.StructField("sales_key", profile.fact_key_type, False),
         T.StructField("sales_id", profile.id_type, profile.name != "gcp"),
         T.StructField("id", T.StringType(), False),
         T.StructField("source_system", T.StringType(), False),
         T.StructField("customer_key", key, True),
         T.StructField("product_key", key, True),
         T.StructField("store_key", key, True),
         T.StructField("sale_time", T.TimestampNTZType(), True),
         T.StructField("sale_date_key", T.DateType(), True),
         T.StructField("quantity", profile.id_type, True),
         T.StructField("total_amount", profile.stored_money_type, True),
         T.StructField("created_at", T.TimestampNTZType(), True)]
    if profile.fact_has_created_date:
        f.append(T.StructField("created_date", T.DateType(), True))
    f += [T.StructField("updated_at", T.TimestampNTZType(), True),
          T.StructField("dwh_load_date", T.TimestampNTZType(), True)]
    return T.StructType(f)


def empty_fact(spark, profile: Profile) -> DataFrame:
    return spark.createDataFrame([], fact_schema(profile))


def _merge_columns(schema: T.StructType, key: str, key_col: str, update_cols, insert_cols,
                   src_cols: list[str], matched_s, matched_t) -> list:
    out = []
    for f in schema.fields:
        c = f.name
        if c == key_col:
            continue
        if c == key:
            v = F.coalesce(F.col(key), F.col(f"_s_{key}"))
        elif c in update_cols and c in src_cols:
            v = F.when(matched_s, F.col(f"_s_{c}")).otherwise(F.col(c))
        elif c in insert_cols and c in src_cols:
            v = F.when(matched_t, F.col(c)).otherwise(F.col(f"_s_{c}"))
        else:
            v = F.col(c)
        out.append(v.cast(f.dataType).alias(c))
    return out


def upsert(target: DataFrame, source: DataFrame, key: str, update_cols: tuple[str, ...],
           insert_cols: tuple[str, ...], key_col: str, key_kind: str, run_ts: str,
           schema: T.StructType, num_partitions: int | None = None,
           order_cols: list[str] | None = None, key_start: int | None = None,
           strategy: str | None = None, seq: KeySequence | None = None,
           held: DataFrame | None = None) -> DataFrame:
    """Merge ``source`` into ``target`` on ``key``.

    Old rows are one left join of the target with the source, new rows the
    source rows without a target id (anti join). Catalyst and AQE choose the
    joins' form by size; ``strategy`` is a join hint for the source side.
    ``held``: the keys of the source that the target holds, when the caller has them.
    """
    src_cols = list(source.columns)
    s = source.select(*[F.col(c).alias(f"_s_{c}") for c in src_cols], F.lit(True).alias("_s"))
    hinted = s.hint(strategy) if strategy else s
    matched_s = F.coalesce(F.col("_s"), F.lit(False))
    cols = _merge_columns(schema, key, key_col, update_cols, insert_cols, src_cols, matched_s, F.lit(True))
    old = target.join(hinted, target[key] == s[f"_s_{key}"], "left").select(
        F.col(key_col).cast(schema[key_col].dataType).alias(key_col), *cols).select(*schema.names)
    if held is None:
        wanted = source.select(F.col(key).alias("_k"))
        wanted = wanted.hint(strategy) if strategy else wanted
        held = target.select(key).join(wanted, F.col(key) == F.col("_k"), "left_semi")
    hit_ids = held.select(F.col(key).alias("_m_key"))
    fresh = s.join(hit_ids, s[f"_s_{key}"] == hit_ids["_m_key"], "left_anti")
    fresh = _fresh_rows(fresh, schema, key, key_col, update_cols, insert_cols, src_cols)
    if key_kind == "epoch":
        new = fresh.withColumn(key_col, epoch_key(F.col(key), run_ts).cast(schema[key_col].dataType))
    else:  # sequence: existing rows keep theirs; new rows are numbered after the max
        start = key_start if key_start is not None else next_start(seq, target, key_col)
        new = assign_sequence(fresh.drop(key_col), order_cols or [key], start, key_col,
                              schema[key_col].dataType, num_partitions, seq)
    return old.unionByName(new.select(*schema.names))


def _fresh_rows(fresh: DataFrame, schema: T.StructType, key: str, key_col: str, update_cols,
                insert_cols, src_cols: list[str]) -> DataFrame:
    """Source rows with no target row, projected like merged rows."""
    out = []
    for f in schema.fields:
        c = f.name
        if c == key_col:
            v = F.lit(None)
        elif c in src_cols and (c == key or c in update_cols or c in insert_cols):
            v = F.col(f"_s_{c}")
        else:
            v = F.lit(None)
        out.append(v.cast(f.dataType).alias(c))
    return fresh.select(*out)


def upsert_fact(target: DataFrame, staged: DataFrame, profile: Profile, run_ts: str,
                num_partitions: int | None = None, key_start: int | None = None,
                strategy: str | None = None, seq: KeySequence | None = None,
                held: DataFrame | None = None) -> DataFrame:
    """D5 (psql: 8 update columns, sale_date_key kept) / D6 (gcp: 11)."""
    return upsert(target, staged, "id", profile.fact_update_cols, FACT_INSERT_COLS,
                  "sales_key", profile.fact_key_kind, run_ts, fact_schema(profile),
                  num_partitions, order_cols=["sales_id"], key_start=key_start,
                  strategy=strategy, seq=seq, held=held)

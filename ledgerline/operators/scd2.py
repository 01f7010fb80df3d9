"""Slowly changing dimension (type 2) as pure DataFrame work.

``scd2_apply(dim, stage, spec, profile, run)`` returns the next version of
the whole dimension. Plan shape (keyed joins and a union, no window over the
data); the dimension is large and grows every run, a batch is usually small:

1. Old values for the batch: active dimension rows whose key is in the batch,
   a semi join. Catalyst and AQE choose its form by size in bytes: small batch
   keys are broadcast, so the dimension is only scanned.
2. ``stage LEFT JOIN old`` (both batch-sized) with a literal marker for
   "matched" gives ``_hit`` / ``_changed``; it is checkpointed once, because
   it feeds both the rows to open and the keys to close.
3. ``dim LEFT JOIN closed_keys`` flips ``is_active`` / ``effective_end_date``
   on every version of the id (psql: the outer UPDATE filters on id only) or
   on the active one (gcp). Here too the side's size decides the join's form.
4. New versions get carry-forward (psql), keys (sequence or hash), start =
   run time, end NULL, and are appended with ``unionByName``.

Both sides read one immutable snapshot, which is what the psql
data-modifying CTE sees; for gcp "no active version after the close" selects
the same rows as "unmatched or changed" as long as each key has at most one
active version (``gates.require_single_active``).

``scd2_delta`` is the form for stored dimensions, whose history must not be
rewritten: it returns only the rows of touched partitions. A stored dimension
is partitioned by (``is_active``, slot): active rows lie in one of a fixed number of
slots by hash of their key; closed rows lie, where a run closes only active
versions (gcp), in a slot of that run, so that files of earlier closed rows
never change, and where it re-stamps all versions of an id (psql) in the slot
of their key, so that only slots of changed ids are written again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.keys import hash_key, random_key
from ledgerline.functions.predicates import active_rows, change_predicate, rounded
from ledgerline.functions.timestamps import ts_literal
from ledgerline.operators.sequence import KeySequence, assign_sequence, next_start
from ledgerline.plans.profiles import DimSpec, Profile
from ledgerline.session import materialize


def dim_schema(spec: DimSpec, profile: Profile) -> T.StructType:
    """K5: typed dimension table."""
    f = [T.StructField(spec.key_col, profile.dim_key_type, False),
         T.StructField("id", T.StringType(), False),
         T.StructField("source_system", T.StringType(), False),
         T.StructField(spec.natural_id, profile.id_type, True)]
    for a in spec.attrs:
        typ = profile.stored_money_type if a.kind == "money" else T.StringType()
        f.append(T.StructField(a.target, typ, True))
    f.append(T.StructField("created_at", T.TimestampNTZType(), True))
    if profile.writes_created:
        f.append(T.StructField("created_date", T.DateType(), True))
    f += [T.StructField("updated_at", T.TimestampNTZType(), True),
          T.StructField("dwh_load_date", T.TimestampNTZType(), True),
          T.StructField("is_active", T.BooleanType(), True),
          T.StructField("effective_start_date", T.TimestampNTZType(), True),
          T.StructField("effective_end_date", T.TimestampNTZType(), True)]
    return T.StructType(f)


def empty_dim(spark, spec: DimSpec, profile: Profile) -> DataFrame:
    return spark.createDataFrame([], dim_schema(spec, profile))


def _kind(spec: DimSpec, col: str) -> str:
    if col in spec.attr_cols:
        return spec.attr(col).kind
    return "time"


def changed_rows(stage: DataFrame, dim: DataFrame, spec: DimSpec, profile: Profile,
                 strategy: str | None = None) -> DataFrame:
    """Steps 1-2: staged rows joined to their active version.

    Adds ``_hit`` (an active version exists), ``_changed`` (change test is
    TRUE) and the old values as ``_o_<col>``. ``strategy``: a join hint for
    the batch side; by default Catalyst and AQE choose by size.
    """
    keys = profile.match_keys(spec)
    tracked = profile.tracked(spec)
    old_cols = list(dict.fromkeys(tracked + spec.attr_cols))
    active = active_rows(dim).select(
        *[F.col(k).alias(f"_d_{k}") for k in keys],
        *[F.col(c).alias(f"_o_{c}") for c in old_cols],
        F.lit(True).alias("_hit"))
    batch_keys = _hinted(stage.select(*[F.col(k).alias(f"_b_{k}") for k in keys]), strategy)
    active = active.join(batch_keys, [active[f"_d_{k}"] == batch_keys[f"_b_{k}"] for k in keys], "left_semi")
    cond = [stage[k] == active[f"_d_{k}"] for k in keys]
    j = stage.join(active, cond, "left").drop(*[f"_d_{k}" for k in keys])
    pairs = [(F.col(f"_o_{c}"), F.col(c), _kind(spec, c)) for c in tracked]
    if profile.round_before_compare:
        pairs = rounded(pairs, profile.stored_money_type.simpleString())
    pred = change_predicate(profile.change_rule, pairs)
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    return (j.withColumn("_hit", hit)
             .withColumn("_changed", hit & F.coalesce(pred, F.lit(False))))


def _hinted(df: DataFrame, strategy: str | None) -> DataFrame:
    return df.hint(strategy) if strategy else df


def versions_to_open(joined: DataFrame) -> DataFrame:
    return joined.filter(~F.col("_hit") | F.col("_changed"))


def close_versions(dim: DataFrame, closed_keys: DataFrame, keys: list[str], scope: str,
                   run_ts: str, strategy: str | None = None) -> DataFrame:
    """End the versions of the changed keys."""
    marked = _hinted(closed_keys.select(*keys).withColumn("_close", F.lit(True)), strategy)
    j = dim.join(marked, keys, "left")
    hit = F.coalesce(F.col("_close"), F.lit(False))
    if scope == "active":
        hit = hit & F.coalesce(F.col("is_active"), F.lit(False))
    # both columns are computed from the pre-close row in one projection
    return j.select(*[
        F.when(hit, F.lit(False)).otherwise(F.col(c)).alias(c) if c == "is_active" else
        F.when(hit, ts_literal(run_ts)).otherwise(F.col(c)).alias(c)
        if c == "effective_end_date" else F.col(c)
        for c in dim.columns])


def new_versions(opened: DataFrame, spec: DimSpec, profile: Profile, run_ts: str,
                 stamp: str, key_start: int | None = None, dim: DataFrame | None = None,
                 num_partitions: int | None = None,
                 seq: KeySequence | None = None) -> DataFrame:
    """Rows to insert, typed like the dimension."""
    schema = dim_schema(spec, profile)
    cols = {}
    for a in spec.attrs:
        v = F.col(a.target)
        if profile.carry_forward and a.kind == "text":
            v = F.coalesce(v, F.col(f"_o_{a.target}"))  # X6
        cols[a.target] = v.cast(profile.stored_money_type) if a.kind == "money" else v
    if profile.writes_created:
        cols["created_at"] = F.col("created_at")
        cols["created_date"] = F.col("created_date")
    else:
        cols["created_at"] = F.lit(None).cast("timestamp_ntz")
    if spec.name == "store" and profile.store_load_date_is_run_ts:
        cols["dwh_load_date"] = ts_literal(run_ts)
    cols["is_active"] = F.lit(True)
    cols["effective_start_date"] = ts_literal(run_ts)
    cols["effective_end_date"] = F.lit(None).cast("timestamp_ntz")
    if profile.dim_key_kind == "hash":
        cols[spec.key_col] = hash_key("id", stamp)
    elif profile.dim_key_kind == "uuid":
        # GENERATE_UUID() literally: not repeatable, so only for paths that
        # write the rows before anything reads the keys (the jobs do)
        cols[spec.key_col] = random_key()
    rows = opened.select(*[
        (cols[f.name] if f.name in cols else F.col(f.name)).cast(f.dataType).alias(f.name)
        for f in schema.fields if f.name != spec.key_col or profile.dim_key_kind != "sequence"])
    if profile.dim_key_kind == "sequence":
        start = key_start if key_start is not None else next_start(seq, dim, spec.key_col)
        rows = assign_sequence(rows, [spec.natural_id], start, spec.key_col,
                               profile.dim_key_type, num_partitions, seq)
    return rows.select(*[f.name for f in schema.fields])


def scd2_apply(dim: DataFrame, stage: DataFrame, spec: DimSpec, profile: Profile,
               run_ts: str, stamp: str, num_partitions: int | None = None,
               key_start: int | None = None, strategy: str | None = None,
               seq: KeySequence | None = None) -> DataFrame:
    """Next version of the whole dimension after one staged batch.

    ``key_start`` / ``seq``: last sequence key, when the caller keeps it
    (``seq`` is advanced past the new keys); ``strategy``: a join hint."""
    keys = profile.match_keys(spec)
    joined = materialize(changed_rows(stage, dim, spec, profile, strategy))
    opened = versions_to_open(joined)
    closed_keys = opened.filter(F.col("_hit")).select(*keys)
    kept = close_versions(dim, closed_keys, keys, profile.close_scope, run_ts, strategy)
    added = new_versions(opened, spec, profile, run_ts, stamp, key_start=key_start, dim=dim,
                         num_partitions=num_partitions, seq=seq)
    return kept.unionByName(added)


def slot_of(keys: list[str], slots: int) -> Column:
    """Slot of a key among ``slots``; the name says of how many."""
    number = F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("string")
    return F.concat(F.lpad(number, 5, "0"), F.lit(f"-of-{slots}"))


def scd2_delta(dim: DataFrame, stage: DataFrame, spec: DimSpec, profile: Profile, run_ts: str, stamp: str,
               slot_col: str, slots: int, seq: KeySequence | None = None,
               num_partitions: int | None = None) -> DataFrame | None:
    """Rows of every partition (``is_active``, ``slot_col``) that the batch
    touches, after it; None if it opens no version. ``dim`` has ``slot_col``.

    The touched slots (at most ``slots`` names) go through the driver, so that
    the scans of the dimension are pruned when they are planned."""
    keys = profile.match_keys(spec)
    opened = versions_to_open(materialize(changed_rows(stage, dim, spec, profile)))
    slot = slot_of(keys, slots)
    touched = [r[0] for r in opened.select(slot).distinct().collect()]
    if not touched:
        return None
    closed_keys = opened.filter(F.col("_hit")).select(*keys)
    every = profile.close_scope == "all_versions"
    old = (dim if every else active_rows(dim)).filter(F.col(slot_col).isin(touched))
    kept = close_versions(old, closed_keys, keys, profile.close_scope, run_ts)
    if not every:
        mine = F.lit(f"{stamp}-{uuid.uuid4().hex[:8]}")
        kept = kept.withColumn(slot_col, F.when(F.col("is_active"), F.col(slot_col)).otherwise(mine))
    added = new_versions(opened, spec, profile, run_ts, stamp, dim=dim, num_partitions=num_partitions, seq=seq)
    return kept.unionByName(added.withColumn(slot_col, slot))

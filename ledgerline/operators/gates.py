"""Constraint gates and row counts.

Each gate is one distributed aggregate whose result is a handful of numbers;
only those numbers reach the driver. Duplicate detection groups by key with
map-side partial counts, so a hot key costs one row per map task.
"""

from __future__ import annotations

from functools import reduce

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class GateError(ValueError):
    """A data gate failed; nothing was written."""


def null_counts(df: DataFrame, cols: list[str]) -> dict[str, int]:
    row = df.agg(*[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).alias(c)
                   for c in cols]).first()
    return {c: int(row[c] or 0) for c in cols}


def require_not_null(df: DataFrame, cols: list[str], label: str = "table") -> None:
    """C1."""
    bad = {c: n for c, n in null_counts(df, cols).items() if n}
    if bad:
        raise GateError(f"{label}: NULL in NOT NULL column(s) {bad}")


def duplicate_keys(df: DataFrame, cols: list[str]) -> DataFrame:
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") > 1))


def require_unique(df: DataFrame, cols: list[str], label: str = "table") -> None:
    """At most one row per key."""
    dup = duplicate_keys(df, cols).limit(5).collect()
    if dup:
        sample = [tuple(r[c] for c in cols) for r in dup]
        raise GateError(f"{label}: duplicate key {cols}, e.g. {sample}")


def require_single_active(dim: DataFrame, keys: list[str], label: str = "dimension") -> None:
    """At most one active version per key (needed by the gcp rewrite)."""
    require_unique(dim.filter(F.col("is_active") == F.lit(True)), keys, label)


def require_max_length(df: DataFrame, limits: dict[str, int], label: str = "table") -> None:
    """Declared VARCHAR(n) lengths, one aggregate over all limited columns.

    (Decimal ranges need no gate: the ANSI cast to DECIMAL(p,s) raises on
    overflow.)"""
    cols = [c for c in limits if c in df.columns]
    if not cols:
        return
    row = df.agg(*[F.max(F.length(F.col(c))).alias(c) for c in cols]).first()
    bad = {c: row[c] for c in cols if row[c] is not None and row[c] > limits[c]}
    if bad:
        raise GateError(f"{label}: value longer than declared in {bad} (limits {limits})")


def observed_metrics(required: Iterable[str] = (), lengths: Mapping[str, int] = {},
                     largest: Iterable[str] = ()) -> list[Column]:
    """C1, C5 and the last key as metrics for ``DataFrame.observe``: gathered by
    the job that writes the rows, so the gates read nothing again."""
    return ([F.sum(F.col(c).isNull().cast("long")).alias(f"nulls.{c}") for c in required]
            + [F.max(F.length(c)).alias(f"length.{c}") for c in lengths]
            + [F.max(c).alias(f"largest.{c}") for c in largest])


def require_observed(counted: Mapping[str, int | None], label: str, required: Iterable[str] = (),
                     lengths: Mapping[str, int] = {}, rows: bool = False) -> None:
    """The gates on what ``observed_metrics`` gathered; ``rows``: K9 too."""
    if rows and not counted["n_rows"]:
        raise GateError(f"{label}: no rows")
    nulls = {c: counted[f"nulls.{c}"] for c in required if counted[f"nulls.{c}"]}
    if nulls:
        raise GateError(f"{label}: NULL in NOT NULL column(s) {nulls}")
    long = {c: counted[f"length.{c}"] for c, n in lengths.items() if (counted[f"length.{c}"] or 0) > n}
    if long:
        raise GateError(f"{label}: value longer than declared in {long} (limits {dict(lengths)})")


def require_rows(df: DataFrame, label: str = "table") -> None:
    """K9: the table must not be empty."""
    if df.isEmpty():
        raise GateError(f"{label}: no rows")


def require_batch_key(df: DataFrame, keys: list[str], label: str = "batch") -> int:
    """K9 + C1 + C4 in one grouped pass: rows exist, no NULL key, no key twice.

    Counts per key (partial aggregation before the shuffle), then one global
    sum; returns the row count."""
    r = _key_stats(df, keys).first()
    if not r["n_rows"]:
        raise GateError(f"{label}: no rows")
    if r["n_null_keys"]:
        raise GateError(f"{label}: {r['n_null_keys']} row(s) with NULL key {keys}")
    if r["n_duplicate_keys"]:
        raise GateError(f"{label}: {r['n_duplicate_keys']} duplicate key(s) {keys}")
    return int(r["n_rows"])


def _key_stats(df: DataFrame, keys: list[str]) -> DataFrame:
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    dup = ~null_key & (F.col("n") > 1)
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_rows"),
        F.coalesce(F.sum(F.when(null_key, F.col("n"))), F.lit(0)).cast("long")
        .alias("n_null_keys"),
        F.count(F.when(dup, F.lit(1))).cast("long").alias("n_duplicate_keys"),
        F.coalesce(F.sum(F.when(dup, F.col("n"))), F.lit(0)).cast("long")
        .alias("n_duplicate_rows"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """A1: (table_name, n) per table, one partial-aggregate job per table."""
    parts = [df.agg(F.count(F.lit(1)).cast("long").alias("n"))
               .select(F.lit(name).alias("table_name"), F.col("n"))
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def constraint_report(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Per table: rows, NULL keys, keys seen more than once and their rows.

    ``tables``: name -> (frame, key columns). One grouped pass per table:
    count per key (partial aggregation before the shuffle), then a global
    sum over the per-key counts.
    """
    parts = [_key_stats(df, keys).select(F.lit(name).alias("table_name"), "n_rows",
                                         "n_null_keys", "n_duplicate_keys", "n_duplicate_rows")
             for name, (df, keys) in tables.items()]
    return reduce(DataFrame.unionByName, parts)

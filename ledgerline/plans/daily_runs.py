"""Multi-day warehouse runs over the retail views, as DataFrames.

These chain the operators exactly as the jobs do, but keep every table as a
DataFrame instead of writing snapshots. Used by the registered queries and
the benchmark.

``shuffle=True`` asks for the plans of large batches (sort-merge joins instead
of broadcasts, lookups through the salted join), so the oracle checks those
plans too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.operators.lookup import lookup_keys
from ledgerline.operators.scd2 import empty_dim, scd2_apply
from ledgerline.operators.sequence import KeySequence
from ledgerline.operators.staging import stage_dimension, stage_sales
from ledgerline.operators.upsert import empty_fact, upsert_fact
from ledgerline.plans.parallel import run_parallel
from ledgerline.plans.profiles import DIMENSIONS, DimSpec, Profile
from ledgerline.session import materialize
from ledgerline.sources.retail import RUNS, dimension_source, sales_source


def staged_dimension(spark: SparkSession, sf_dir: str, spec: DimSpec, profile: Profile,
                     batch: str) -> DataFrame:
    run = RUNS[batch]
    src = dimension_source(spark, sf_dir, spec.source_table, batch, profile)
    return stage_dimension(src, spec, profile, run.run_ts, run.stamp)


def dimension_after(spark: SparkSession, sf_dir: str, spec: DimSpec, profile: Profile,
                    batches: tuple[str, ...], start: DataFrame | None = None,
                    shuffle: bool = False, seq: KeySequence | None = None) -> DataFrame:
    dim = start if start is not None else empty_dim(spark, spec, profile)
    if seq is None:  # from empty the sequence is known; else scan once
        seq = KeySequence(0 if start is None else None)
    for i, b in enumerate(batches):
        run = RUNS[b]
        stage = staged_dimension(spark, sf_dir, spec, profile, b)
        # scd2_apply checkpoints its batch-sized intermediate results, so the
        # next day's plan stays short without materialising the whole dimension
        dim = scd2_apply(dim, stage, spec, profile, run.run_ts, run.stamp,
                         strategy="merge" if shuffle else None, seq=seq)
    return dim


def all_dimensions_after(spark: SparkSession, sf_dir: str, profile: Profile,
                         batches: tuple[str, ...], shuffle: bool = False) -> dict[str, DataFrame]:
    return run_parallel({name: (lambda spec=spec: dimension_after(spark, sf_dir, spec, profile,
                                                                  batches, shuffle=shuffle))
                         for name, spec in DIMENSIONS.items()})


def staged_fact(spark: SparkSession, sf_dir: str, profile: Profile, batch: str,
                dims: dict[str, DataFrame], shuffle: bool = False,
                sales_batch: str | None = None) -> DataFrame:
    run = RUNS[batch]
    sales = sales_source(spark, sf_dir, sales_batch or batch, profile)
    keyed = lookup_keys(sales, dims, profile, salted=shuffle)
    return stage_sales(keyed, profile, run.run_ts, run.stamp)


def fact_after(spark: SparkSession, sf_dir: str, profile: Profile,
               batches: tuple[str, ...] = ("b1", "b2"), shuffle: bool = False) -> DataFrame:
    """Day by day: dims, then staged sales against them, then the fact merge."""
    fact = empty_fact(spark, profile)
    dims = {name: empty_dim(spark, spec, profile) for name, spec in DIMENSIONS.items()}
    seqs = {name: KeySequence(0) for name in DIMENSIONS}
    fact_seq = KeySequence(0)
    for i, b in enumerate(batches):
        run = RUNS[b]
        dims = run_parallel({
            name: (lambda name=name, spec=spec: dimension_after(
                spark, sf_dir, spec, profile, (b,), start=dims[name], shuffle=shuffle,
                seq=seqs[name]))
            for name, spec in DIMENSIONS.items()})
        # the staging table (K2) of the jobs: built once, read by every merge step
        staged = materialize(staged_fact(spark, sf_dir, profile, b, dims, shuffle=shuffle))
        fact = upsert_fact(fact, staged, profile, run.run_ts,
                           strategy="merge" if shuffle else None, seq=fact_seq)
        if i < len(batches) - 1:
            fact = materialize(fact)
    return fact

"""Plan checks: pushdown and pruning reach the scan, no Python UDFs, the
sequence key never runs a single-partition window, dimension lookups are
broadcast (after a size check)."""

from ledgerline.plans import queries
from tests.conftest import SF_SMALL


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udf_anywhere(spark):
    for name, fn in queries.registry().items():
        p = plan_of(fn(spark, SF_SMALL))
        assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_scan_prunes_columns_and_pushes_filters(spark):
    df = queries.registry()["stage_customers_psql"](spark, SF_SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string,c_mktsegment:string>" in p
    active = queries.registry()["fact_stage_psql"](spark, SF_SMALL)
    text = plan_of(active)
    assert "BroadcastHashJoin" in text


def test_no_single_partition_exchange_in_dimension_merge(spark):
    for name in ("scd2_customer_psql", "scd2_customer_gcp", "fact_upsert_psql"):
        p = plan_of(queries.registry()[name](spark, SF_SMALL))
        assert "SinglePartition" not in p, name
        assert "Window" not in p, name


def _written(spark, df, tmp):
    df.write.mode("overwrite").parquet(tmp)
    return spark.read.parquet(tmp)


def test_small_batch_never_shuffles_the_dimension(spark, tmpdir_path):
    """gcp SCD2 with a dimension read from parquet and a small batch: the
    final plan streams the dimension through broadcast joins only."""
    import os

    from ledgerline.operators.scd2 import scd2_apply
    from ledgerline.plans.daily_runs import dimension_after, staged_dimension
    from ledgerline.plans.profiles import CUSTOMER, GCP
    from ledgerline.sources.retail import RUNS
    dim = _written(spark, dimension_after(spark, SF_SMALL, CUSTOMER, GCP, ("b1",)),
                   os.path.join(tmpdir_path, "dim"))
    stage = staged_dimension(spark, SF_SMALL, CUSTOMER, GCP, "b2")
    out = scd2_apply(dim, stage, CUSTOMER, GCP, RUNS["b2"].run_ts, RUNS["b2"].stamp)
    p = plan_of(out)
    assert "Exchange hashpartitioning" not in p and "SortMergeJoin" not in p
    assert "BroadcastHashJoin" in p


def test_small_batch_never_shuffles_the_fact(spark, tmpdir_path):
    import os

    from ledgerline.operators.upsert import upsert_fact
    from ledgerline.plans.daily_runs import fact_after, staged_fact, all_dimensions_after
    from ledgerline.plans.profiles import GCP
    from ledgerline.sources.retail import RUNS
    fact = _written(spark, fact_after(spark, SF_SMALL, GCP, ("b1",)), os.path.join(tmpdir_path, "f"))
    dims = all_dimensions_after(spark, SF_SMALL, GCP, ("b1", "b2"))
    staged = _written(spark, staged_fact(spark, SF_SMALL, GCP, "b2", dims),
                      os.path.join(tmpdir_path, "s"))
    p = plan_of(upsert_fact(fact, staged, GCP, RUNS["b2"].run_ts))
    assert "Exchange hashpartitioning" not in p and "SortMergeJoin" not in p


def test_stored_dimension_is_pruned_to_touched_slots(spark, tmpdir_path):
    """Old values come from active partitions only, and the rows written from
    the slots that the batch touches."""
    import os

    from ledgerline.operators.scd2 import changed_rows, scd2_delta
    from ledgerline.plans.daily_runs import staged_dimension
    from ledgerline.plans.jobs import dim_table, load_dimension
    from ledgerline.plans.profiles import CUSTOMER, GCP
    from ledgerline.plans.tables import SLOT, Warehouse
    from ledgerline.sources.retail import RUNS
    wh = Warehouse(spark, os.path.join(tmpdir_path, "wh"), db_prefix="pr_", dim_slots=32)
    wh.ensure_schemas("dwh")
    for b in ("b1", "b2"):
        stage = staged_dimension(spark, SF_SMALL, CUSTOMER, GCP, b)
        load_dimension(wh, CUSTOMER, GCP, stage, RUNS[b].run_ts, RUNS[b].stamp)
    name = dim_table(CUSTOMER, GCP)
    dim = spark.table(wh.q(name))
    assert "/is_active=false/" not in "".join(changed_rows(stage, dim, CUSTOMER, GCP).select("_o_customer_name").inputFiles())
    assert "PartitionFilters: [isnotnull(is_active" in plan_of(changed_rows(stage, dim, CUSTOMER, GCP))
    one = stage.limit(1).selectExpr("*").drop("customer_name").selectExpr("*", "'other' AS customer_name").checkpoint()
    delta = scd2_delta(dim, one, CUSTOMER, GCP, RUNS["b3"].run_ts, RUNS["b3"].stamp, SLOT, wh.slots(name))
    assert f"{SLOT}" in plan_of(delta).split("PartitionFilters: ")[1].split("]")[0]
    slots = {r[0] for r in delta.where("is_active").select(SLOT).distinct().collect()}
    assert len(slots) == 1 and delta.where("NOT is_active").count() == 1

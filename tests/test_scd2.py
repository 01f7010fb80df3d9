"""D1-D4 on hand-made batches: first load, unchanged re-run, change,
change again (psql re-stamps old versions, gcp does not), NULLs, new and
vanished ids; plus the invariants that must hold after every batch."""

from datetime import datetime

from pyspark.sql import functions as F

from ledgerline.operators.scd2 import empty_dim, scd2_apply
from ledgerline.operators.staging import stage_dimension
from ledgerline.plans.profiles import CUSTOMER, GCP, PSQL, with_rule

T0 = datetime(2024, 1, 1)
SCHEMA = "customer_id long, name string, address string, created_at timestamp_ntz, updated_at timestamp_ntz"
RUNS = [("2024-01-01 03:00:00", "20240101030000"), ("2024-01-02 03:00:00", "20240102030000"),
        ("2024-01-03 03:00:00", "20240103030000"), ("2024-01-04 03:00:00", "20240104030000")]

BATCHES = [
    [(1, "Ann", "Elm"), (2, "Bob", None), (3, "Cy", "Oak")],
    [(1, "Ann", "Elm"), (2, "Bob", None), (3, "Cy", "Oak")],            # unchanged
    [(1, "Ann", "Pine"), (2, "Bob", "Ash"), (4, "Di", "Fir")],          # change, NULL->b, new, 3 vanished
    [(1, "Ann", "Birch"), (2, "Bob", None), (4, "Di", "Fir")],          # change again, b->NULL
]


def run(spark, profile, n):
    dim = empty_dim(spark, CUSTOMER, profile)
    for (run_ts, stamp), rows in list(zip(RUNS, BATCHES))[:n]:
        src = spark.createDataFrame([(i, a, b, T0, T0) for i, a, b in rows], SCHEMA)
        stage = stage_dimension(src, CUSTOMER, profile, run_ts, stamp)
        dim = spark.createDataFrame(scd2_apply(dim, stage, CUSTOMER, profile, run_ts, stamp).collect(),
                                    dim.schema)
    return dim


def versions(dim):
    return sorted(((r.customer_id, r.customer_address, r.is_active, str(r.effective_end_date))
                   for r in dim.collect()), key=lambda v: tuple(str(x) for x in v))


def check_invariants(dim, key):
    active = dim.filter("is_active").groupBy("customer_id").count()
    assert active.filter("count > 1").count() == 0
    assert dim.select(key).distinct().count() == dim.count()


def test_unchanged_rerun_adds_nothing(spark):
    for prof in (PSQL, GCP, with_rule(PSQL, "nullsafe")):
        assert run(spark, prof, 1).count() == run(spark, prof, 2).count() == 3


def test_psql_history(spark):
    dim = run(spark, PSQL, 4)
    check_invariants(dim, "customer_key")
    got = versions(dim)
    # id 1: Elm, Pine, Birch; the first two both end at the last close (all versions)
    assert (1, "Elm", False, "2024-01-04 03:00:00") in got
    assert (1, "Pine", False, "2024-01-04 03:00:00") in got
    assert (1, "Birch", True, "None") in got
    # id 2: NULL -> Ash is a change; Ash -> NULL is not
    assert sorted([v for v in got if v[0] == 2], key=str) == sorted(
        [(2, None, False, "2024-01-03 03:00:00"), (2, "Ash", True, "None")], key=str)
    # vanished id 3 keeps its active version
    assert (3, "Oak", True, "None") in got
    keys = sorted(r.customer_key for r in dim.collect())
    assert keys == list(range(1, len(keys) + 1))


def test_gcp_history(spark):
    dim = run(spark, GCP, 4)
    check_invariants(dim, "customer_key")
    got = versions(dim)
    # only the active version is closed: Elm keeps its first end date
    assert (1, "Elm", False, "2024-01-03 03:00:00") in got
    assert (1, "Pine", False, "2024-01-04 03:00:00") in got
    # NULL -> Ash is no change under the hash rule
    assert [v for v in got if v[0] == 2] == [(2, None, True, "None")]
    assert dim.filter(F.length("customer_key") != 32).count() == 0


def test_carry_forward_psql(spark):
    """A NULL text attribute in a changed row takes the old value (psql)."""
    dim = empty_dim(spark, CUSTOMER, PSQL)
    b1 = spark.createDataFrame([(1, "Ann", "Elm", T0, T0)], SCHEMA)
    b2 = spark.createDataFrame([(1, "Anne", None, T0, T0)], SCHEMA)
    for (run_ts, stamp), src in zip(RUNS, (b1, b2)):
        stage = stage_dimension(src, CUSTOMER, PSQL, run_ts, stamp)
        dim = spark.createDataFrame(scd2_apply(dim, stage, CUSTOMER, PSQL, run_ts, stamp).collect(),
                                    dim.schema)
    new = dim.filter("is_active").first()
    assert (new.customer_name, new.customer_address, new.created_at) == ("Anne", "Elm", None)

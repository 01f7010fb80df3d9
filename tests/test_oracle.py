"""Every registered query against its DuckDB oracle (sf0.001), plus the
driver contract shape."""

import pytest

import __spark_entry__ as entry
from ledgerline.plans import oracle, queries
from tests.compare import compare, duckdb_con
from tests.conftest import SF_SMALL

NAMES = sorted(queries.registry())


def test_every_query_has_oracle():
    assert set(NAMES) == set(oracle.registry())
    assert set(NAMES) <= set(entry.queries()) and set(NAMES) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duckdb_con(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, entry.queries()[name], entry.oracle_sql()[name], SF_SMALL, con)
    assert r["cols_ok"], (r["spark_cols"], r["oracle_cols"])
    assert r["rows_ok"], (r["spark_sample"], r["oracle_sample"])
    assert r["spark_rows"] > 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "sales_key" in df.columns


@pytest.mark.parametrize("name", ["fact_merge_gcp", "stage_customers_gcp", "scd2_store_gcp"])
def test_session_time_zone_does_not_matter(spark, con, name):
    """Zone-less time stamps throughout: a non-UTC session gives the same rows."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        r = compare(spark, name, entry.queries()[name], entry.oracle_sql()[name], SF_SMALL, con)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r["cols_ok"] and r["rows_ok"], (r["spark_sample"], r["oracle_sample"])

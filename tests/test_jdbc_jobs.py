"""S5 (JDBC copy, against in-process Derby: no server, no port), W1, W2, W3
and publication by the catalog (D7)."""

import glob
import os
from datetime import datetime

import pytest

from ledgerline.operators.gates import GateError
from ledgerline.plans.jobs import job_gcp, job_load_csv, job_psql
from ledgerline.plans.tables import Warehouse
from ledgerline.sources.jdbc import read_jdbc_table, write_jdbc_table
from tests.fixtures import FILES, HEADERS, changed, write_files

DERBY = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def derby_url(name):
    return f"jdbc:derby:memory:{name};create=true"


def test_jdbc_partitioned_copy(spark):
    url = derby_url("copytest")
    df = spark.range(1, 1001).selectExpr("CAST(id AS INT) AS k", "CAST(id * 2 AS INT) AS v")
    write_jdbc_table(df, url, "T1", DERBY, truncate=False)
    back = read_jdbc_table(spark, url, "T1", partition_column="k", num_partitions=4,
                           properties=DERBY)
    assert back.rdd.getNumPartitions() == 4
    assert back.count() == 1000 and back.agg({"v": "sum"}).first()[0] == 1001000


def test_w1_then_w2(spark, tmpdir_path):
    wh = Warehouse(spark, os.path.join(tmpdir_path, "wh"), db_prefix="w2_")
    files = write_files(os.path.join(tmpdir_path, "in"))
    job_load_csv(spark, wh, files)
    cust = {r.customer_id: r for r in wh.read("public.customers").collect()}
    assert cust[42].address is None and cust[41].address == "Quay 4, Upper Town"
    assert cust[47].name == 'Pia "P" Voss'
    # the loaded source tables become the JDBC source of the psql warehouse
    url = derby_url("w2src")
    for t in FILES:
        write_jdbc_table(wh.read(f"public.{t}"), url, t, DERBY, truncate=False)
    r1 = job_psql(spark, wh, url, "2024-03-13 03:00:00", DERBY, partitions=2)
    assert r1.written == {"dwh.dim_customer": 4, "dwh.dim_product": 3, "dwh.dim_store": 2, "dwh.fact_sales": 4}
    fact = {r.sales_id: r for r in wh.read("dwh.fact_sales").collect()}
    assert fact[7009].store_key is None  # store 88 unknown: LEFT join keeps the sale
    assert fact[7001].updated_at == datetime(2024, 3, 10, 12)  # psql: the sale date
    # unchanged re-run: no new dimension versions, same fact rows
    r2 = job_psql(spark, wh, url, "2024-03-14 03:00:00", DERBY, partitions=2)
    assert wh.read("dwh.dim_customer").count() == 4
    assert wh.read("dwh.fact_sales").count() == 4
    assert [r2.written[f"dwh.dim_{d}"] for d in ("customer", "product", "store")] == [0, 0, 0]


def gcp_run(spark, wh, folder, day, files=None):
    """One gcp load of ``files``, landed under ``folder``."""
    paths = write_files(os.path.join(folder, f"in{day}"), files)
    return job_gcp(spark, wh, paths, os.path.join(folder, "landing"), now=datetime(2024, 3, day, 3, 0, 0))


def facts(wh):
    return sorted((r.sales_id, str(r.sale_date_key), r.sales_key) for r in wh.read("dwh.fact_sales").collect())


def test_w3_gcp(spark, tmpdir_path):
    wh = Warehouse(spark, os.path.join(tmpdir_path, "wh"), db_prefix="w3_")
    r = gcp_run(spark, wh, tmpdir_path, 13)
    assert r.stamp == "20240313030000"
    before = facts(wh)
    assert [f[0] for f in before] == [7001, 7002, 7005]  # store 88 unknown: INNER join drops it
    prod = {r.product_id: r for r in wh.read("dwh.dim_product").collect()}
    assert str(prod[900].product_price) == "1250.25"  # no truncation on this path
    # a second run: one changed customer, and a sale that moves to another day
    moved = changed("sales", "7005", sale_date="2024-03-15 09:05:00")
    moved["customers"] = changed("customers", "60", address="Canal Row")["customers"]
    gcp_run(spark, wh, tmpdir_path, 14, moved)
    dim = wh.read("dwh.dim_customer")
    assert dim.count() == 5 and dim.filter("is_active").count() == 4
    after = facts(wh)
    assert after == [*before[:2], (7005, "2024-03-15", before[2][2])]


def test_null_date_is_a_partition(spark, tmpdir_path):
    """A sale without a date gets one, and loses it again: never two rows."""
    wh = Warehouse(spark, os.path.join(tmpdir_path, "wh"), db_prefix="nd_")
    gcp_run(spark, wh, tmpdir_path, 13, changed("sales", "7002", sale_date=""))
    assert [f[:2] for f in facts(wh)] == [(7001, "2024-03-10"), (7002, "None"), (7005, "2024-03-12")]
    gcp_run(spark, wh, tmpdir_path, 14)
    assert [f[:2] for f in facts(wh)] == [(7001, "2024-03-10"), (7002, "2024-03-10"), (7005, "2024-03-12")]
    gcp_run(spark, wh, tmpdir_path, 15, changed("sales", "7002", sale_date=""))
    assert [f[:2] for f in facts(wh)][1] == (7002, "None") and len(facts(wh)) == 3


@pytest.mark.parametrize("step", ["write_pending", "publish", "_set_properties", "finish_pending", "delete_path", "unset"])
def test_crash_between_steps_then_rerun(spark, tmpdir_path, monkeypatch, step):
    """A run that stops before the fact is published leaves the old rows; one
    that stops after publication began is finished by the next run. Each id is
    there once."""
    wh = Warehouse(spark, os.path.join(tmpdir_path, "wh"), db_prefix=f"cr{step.strip('_')}_")
    gcp_run(spark, wh, tmpdir_path, 13)
    moved = changed("sales", "7001", sale_date="2024-03-20 12:00:00")
    whole, sql = getattr(Warehouse, step, None), spark.sql
    reached = []

    def stop(self, *args, **kw):
        begun = step != "finish_pending" or "ledgerline.pending" in self.properties(args[0])
        if any("dwh.fact_sales" in str(a) or str(a).endswith("fact_sales__next") for a in args) and begun:
            reached.append(1)
            raise RuntimeError("stopped")
        return whole(self, *args, **kw)

    def stop_sql(text, *args, **kw):
        if "UNSET" in text and "fact_sales" in text:
            reached.append(1)
            raise RuntimeError("stopped")
        return sql(text, *args, **kw)

    with monkeypatch.context() as m:
        m.setattr(*((spark, "sql", stop_sql) if step == "unset" else (Warehouse, step, stop)))
        with pytest.raises(RuntimeError):
            gcp_run(spark, wh, tmpdir_path, 14, moved)
    assert reached and len(facts(wh)) == 3
    gcp_run(spark, wh, tmpdir_path, 15, moved)
    assert [f[:2] for f in facts(wh)] == [(7001, "2024-03-20"), (7002, "2024-03-10"), (7005, "2024-03-12")]
    assert "ledgerline.pending" not in wh.properties("dwh.fact_sales")


def load_given(spark, wh, prof, batch, run=None, **kw):
    """One batch of the given tables."""
    from ledgerline.plans.jobs import job_warehouse
    from ledgerline.sources.retail import RUNS, dimension_source, sales_source
    sf = "/root/testdata/sf0.001"
    src = {t: dimension_source(spark, sf, t, batch, prof) for t in ("customers", "products", "stores")}
    src["sales"] = sales_source(spark, sf, batch, prof)
    run = RUNS[run or batch]
    return job_warehouse(spark, wh, prof, src, run.run_ts, run.stamp, **kw)


def test_stopped_run_never_repeats_a_sequence_key(spark, tmpdir_path, monkeypatch):
    from ledgerline.plans.profiles import PSQL
    wh = Warehouse(spark, os.path.join(tmpdir_path, "wh"), db_prefix="sk_")
    load_given(spark, wh, PSQL, "b1", parallel=False)
    whole = Warehouse.finish_pending

    def stop(self, name):
        if name in ("dwh.dim_customer", "dwh.fact_sales") and "ledgerline.pending" in self.properties(name):
            raise RuntimeError("stopped")
        return whole(self, name)

    with monkeypatch.context() as m:
        m.setattr(Warehouse, "finish_pending", stop)
        with pytest.raises(RuntimeError):
            load_given(spark, wh, PSQL, "b2", parallel=False)
    load_given(spark, wh, PSQL, "b2")
    for name, key in (("dim_customer", "customer_key"), ("fact_sales", "sales_key")):
        df = wh.read(f"dwh.{name}")
        assert df.select(key).distinct().count() == df.count()
    assert wh.read("dwh.fact_sales").select("id").distinct().count() == wh.read("dwh.fact_sales").count()


def files_of(wh, name, pattern):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{wh.location(name)}/{pattern}/*.parquet")}


def test_closed_versions_are_never_written_again(spark, tmpdir_path):
    """gcp: a run's closed rows are files of their own. psql: only slots of
    changed ids are written. Untouched fact partitions keep their files."""
    from ledgerline.plans.profiles import GCP, PSQL
    for prof, prefix in ((GCP, "hg_"), (PSQL, "hp_")):
        wh = Warehouse(spark, os.path.join(tmpdir_path, prof.name), db_prefix=prefix, dim_slots=64)
        load_given(spark, wh, prof, "b1")
        load_given(spark, wh, prof, "b2")
        name = "dwh.dim_customer"
        closed, active = files_of(wh, name, "is_active=false/*"), files_of(wh, name, "is_active=true/*")
        assert closed and len(active) > 10
        dim = wh.read(name)
        one = dim.where("is_active").select("customer_id").first()[0]
        from ledgerline.plans.jobs import load_dimension
        from ledgerline.plans.profiles import CUSTOMER
        before = spark.table(wh.q(name)).where(f"customer_id = {one}").collect()
        stage_cols = [c for c in wh.read("stage.dim_customer" if prof is PSQL else "staging.dim_customer").columns]
        staged = wh.read("stage.dim_customer" if prof is PSQL else "staging.dim_customer").where(f"customer_id = {one}")
        assert staged.count() == 1
        from pyspark.sql import functions as F
        staged = staged.withColumn("customer_address", F.lit("elsewhere")).select(stage_cols)
        assert load_dimension(wh, CUSTOMER, prof, staged, "2024-02-01 00:00:00", "20240201000000") >= 2
        after_closed, after_active = files_of(wh, name, "is_active=false/*"), files_of(wh, name, "is_active=true/*")
        if prof is GCP:
            assert closed.items() <= after_closed.items() and len(after_closed) == len(closed) + 1
        else:
            slot = [r.load_slot for r in before][0]
            assert {f: t for f, t in closed.items() if slot not in f}.items() <= after_closed.items()
        assert sum(1 for f in active if f not in after_active) <= len(glob.glob(f"{wh.location(name)}/is_active=true/{before[-1].load_slot}")) + 2
        got = wh.read(name).where(f"customer_id = {one}")
        assert got.count() == len(before) + 1 and got.where("is_active").first().customer_address == "elsewhere"


def test_unchanged_batch_writes_nothing_when_asked(spark, tmpdir_path):
    from ledgerline.plans.profiles import GCP, PSQL
    for prof, prefix in ((GCP, "ug_"), (PSQL, "up_")):
        wh = Warehouse(spark, os.path.join(tmpdir_path, prof.name), db_prefix=prefix)
        load_given(spark, wh, prof, "b1")
        load_given(spark, wh, prof, "b2")
        rows, kept = wh.read("dwh.fact_sales").collect(), files_of(wh, "dwh.fact_sales", "*")
        again = load_given(spark, wh, prof, "b2", "b3", skip_unchanged=True)
        assert set(again.written.values()) == {0} and files_of(wh, "dwh.fact_sales", "*") == kept
        assert load_given(spark, wh, prof, "b2", "b3").written["dwh.fact_sales"] > 0  # the default stamps the load time
        assert len(wh.read("dwh.fact_sales").collect()) == len(rows)


def test_failed_gate_leaves_the_table(spark, tmpdir_path):
    wh = Warehouse(spark, os.path.join(tmpdir_path, "wh"), db_prefix="fg_")
    wh.ensure_schemas("t")

    def refuse(counted):
        assert counted["n_rows"] == 3
        raise GateError("no")
    for _ in range(2):
        with pytest.raises(GateError):
            wh.replace_table(spark.range(3), "t.x", gates=refuse)
    assert not wh.exists("t.x")
    assert wh.replace_table(spark.range(4), "t.x") == 4
    with pytest.raises(GateError):
        wh.replace_table(spark.range(3), "t.x", gates=refuse)
    assert wh.read("t.x").count() == 4


def test_gates_read_nothing_again(spark, tmpdir_path):
    """Rows, NULLs and lengths are counted by the job that writes."""
    from ledgerline.operators.gates import observed_metrics, require_observed
    wh = Warehouse(spark, os.path.join(tmpdir_path, "wh"), db_prefix="ob_")
    wh.ensure_schemas("t")
    df = spark.range(100).selectExpr("id", "IF(id = 7, NULL, concat('n', id)) AS name")
    jobs = []
    for metrics in ((), observed_metrics(["id", "name"], {"name": 2}, ["id"])):
        spark.sparkContext.setJobGroup(f"gates{len(metrics)}", "")
        path, counted = wh.write_aside(df, "t.x", metrics)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"gates{len(metrics)}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1] and counted["n_rows"] == 100 and counted["largest.id"] == 99
    require_observed(counted, "x", ["id"], {}, rows=True)
    with pytest.raises(GateError, match="NULL"):
        require_observed(counted, "x", ["name"])
    with pytest.raises(GateError, match="longer"):
        require_observed(counted, "x", [], {"name": 2})


def test_empty_file_gate(spark, tmpdir_path):
    wh = Warehouse(spark, os.path.join(tmpdir_path, "wh"), db_prefix="w1_")
    files = write_files(os.path.join(tmpdir_path, "in"),
                        {"customers": HEADERS["customers"] + "\n"})
    with pytest.raises(GateError):
        job_load_csv(spark, wh, files)
    assert not wh.exists("public.customers")


def test_replaced_table_swaps_in_one_step(spark, tmpdir_path):
    wh = Warehouse(spark, os.path.join(tmpdir_path, "wh"), db_prefix="snap_")
    wh.ensure_schemas("t")
    for i in range(1, 4):
        old = wh.read("t.x") if i > 1 else None
        path, _ = wh.write_aside(spark.range(i), "t.x")
        assert old is None or old.count() == i - 1  # readers stay until the table points elsewhere
        wh.point_at("t.x", path, spark.range(i).schema)
        assert wh.read("t.x").count() == i
    assert len(os.listdir(wh.location("t.x"))) == 2
    assert wh.replace_table(spark.range(2).selectExpr("id", "'v' AS extra"), "t.x") == 2  # another schema
    assert wh.read("t.x").columns == ["id", "extra"]
    wh.drop_table("t.x")
    assert not wh.exists("t.x") and not os.path.exists(wh.location("t.x"))


@pytest.mark.parametrize("pname", ["psql", "gcp"])
def test_warehouse_is_found_again_by_an_empty_catalog(spark, tmpdir_path, pname):
    from ledgerline.plans.jobs import read_fact
    from ledgerline.plans.profiles import PROFILES
    prof, root = PROFILES[pname], os.path.join(tmpdir_path, "wh")
    wh = Warehouse(spark, root, db_prefix=f"ra{pname}_")
    load_given(spark, wh, prof, "b1")
    held = sorted(map(str, read_fact(wh, prof).collect()))
    spark.sql(f"DROP DATABASE ra{pname}_dwh CASCADE")  # the catalog forgets; files of external tables stay
    wh2 = Warehouse(spark, root, db_prefix=f"ra{pname}_")
    wh2.ensure_schemas("dwh")
    assert sorted(map(str, read_fact(wh2, prof).collect())) == held
    load_given(spark, wh2, prof, "b2")
    dim, fact = wh2.read("dwh.dim_customer"), wh2.read("dwh.fact_sales")
    assert dim.select("customer_key").distinct().count() == dim.count()
    assert fact.select("sales_key").distinct().count() == fact.count()


def test_fact_sequence_recorded(spark, tmpdir_path):
    """psql fact keys continue from the recorded sequence, not a fact scan."""
    from ledgerline.plans.jobs import job_warehouse
    from ledgerline.plans.profiles import PSQL
    from ledgerline.sources.retail import RUNS, dimension_source, sales_source
    wh = Warehouse(spark, os.path.join(tmpdir_path, "wh"), db_prefix="seq_")
    sf = "/root/testdata/sf0.001"
    for batch in ("b1", "b2"):
        src = {t: dimension_source(spark, sf, t, batch, PSQL) for t in ("customers", "products", "stores")}
        src["sales"] = sales_source(spark, sf, batch, PSQL)
        job_warehouse(spark, wh, PSQL, src, RUNS[batch].run_ts, RUNS[batch].stamp)
    fact = wh.read("dwh.fact_sales")
    keys = sorted(r.sales_key for r in fact.select("sales_key").collect())
    assert keys == list(range(1, len(keys) + 1))
    assert wh.properties("dwh.fact_sales")["sequence.sales_key"] == str(len(keys))
    for d in ("customer", "product", "store"):
        dim = wh.read(f"dwh.dim_{d}")
        assert wh.properties(f"dwh.dim_{d}")[f"sequence.{d}_key"] == str(dim.agg({f"{d}_key": "max"}).first()[0])


@pytest.mark.parametrize("pname", ["psql", "gcp"])
def test_job_path_equals_oracle_checked_path(spark, tmpdir_path, pname):
    """The written warehouse (snapshots, touched-partition fact) holds exactly
    the rows of the DataFrame runs that the DuckDB oracle checks."""
    from ledgerline.plans.jobs import job_warehouse, read_fact
    from ledgerline.plans.daily_runs import dimension_after, fact_after
    from ledgerline.plans.profiles import DIMENSIONS, PROFILES
    from ledgerline.sources.retail import RUNS, dimension_source, sales_source
    prof = PROFILES[pname]
    wh = Warehouse(spark, os.path.join(tmpdir_path, "wh"), db_prefix=f"eq{pname}_")
    sf = "/root/testdata/sf0.001"
    for batch in ("b1", "b2"):
        src = {t: dimension_source(spark, sf, t, batch, prof) for t in ("customers", "products", "stores")}
        src["sales"] = sales_source(spark, sf, batch, prof)
        job_warehouse(spark, wh, prof, src, RUNS[batch].run_ts, RUNS[batch].stamp)

    def rows(df):
        return sorted(tuple(str(v) for v in r) for r in df.collect())

    got = read_fact(wh, prof)
    assert rows(got) == rows(fact_after(spark, sf, prof).select(*got.columns))
    for name, spec in DIMENSIONS.items():
        d = wh.read(f"dwh.dim_{name}")
        assert rows(d) == rows(dimension_after(spark, sf, spec, prof, ("b1", "b2")).select(*d.columns))


def test_w3_with_registry(spark, tmpdir_path):
    """The registry (S4) supplies the by-position schemas of the gcp load."""
    import yaml

    from ledgerline.plans.profiles import GCP
    from ledgerline.sources.registry import load_registry
    from ledgerline.sources.schemas import source_schema
    kinds = {"bigint": "INTEGER", "double": "FLOAT64", "string": "STRING", "timestamp_ntz": "TIMESTAMP"}
    tables = [{t: {"type": "fact" if t == "sales" else "dimension",
                   "schema_fields": [{"name": f.name, "type": kinds[f.dataType.simpleString()]}
                                     for f in source_schema(t, GCP).fields]}} for t in FILES]
    reg_path = os.path.join(tmpdir_path, "public.yaml")
    with open(reg_path, "w") as fh:
        yaml.safe_dump({"tables": tables}, fh)
    reg = load_registry(reg_path)
    wh = Warehouse(spark, os.path.join(tmpdir_path, "wh"), db_prefix="rg_")
    files = write_files(os.path.join(tmpdir_path, "in"))
    r = job_gcp(spark, wh, {t: files[t] for t in reg}, os.path.join(tmpdir_path, "landing"),
                now=datetime(2024, 3, 13, 3, 0, 0), registry=reg)
    assert r.stamp == "20240313030000"
    assert wh.read("dwh.fact_sales").count() == 3


def test_bad_batch_writes_nothing(spark, tmpdir_path):
    """A duplicate id in one table stops the run before any table is written."""
    from ledgerline.plans.jobs import job_warehouse
    from ledgerline.plans.profiles import PSQL
    from ledgerline.sources.retail import RUNS, dimension_source, sales_source
    wh = Warehouse(spark, os.path.join(tmpdir_path, "wh"), db_prefix="bad_")
    sf = "/root/testdata/sf0.001"
    src = {t: dimension_source(spark, sf, t, "b1", PSQL) for t in ("customers", "products", "stores")}
    src["sales"] = sales_source(spark, sf, "b1", PSQL)
    src["stores"] = src["stores"].unionByName(src["stores"].limit(1))  # one id twice
    with pytest.raises(GateError):
        job_warehouse(spark, wh, PSQL, src, RUNS["b1"].run_ts, RUNS["b1"].stamp)
    for d in ("customer", "product", "store"):
        assert not wh.exists(f"dwh.dim_{d}")


def test_uuid_keys_written_before_read(spark, tmpdir_path):
    from dataclasses import replace

    from ledgerline.plans.jobs import job_warehouse
    from ledgerline.plans.profiles import GCP
    from ledgerline.sources.retail import RUNS, dimension_source, sales_source
    prof = replace(GCP, dim_key_kind="uuid")
    wh = Warehouse(spark, os.path.join(tmpdir_path, "wh"), db_prefix="uu_")
    sf = "/root/testdata/sf0.001"
    src = {t: dimension_source(spark, sf, t, "b1", prof) for t in ("customers", "products", "stores")}
    src["sales"] = sales_source(spark, sf, "b1", prof)
    job_warehouse(spark, wh, prof, src, RUNS["b1"].run_ts, RUNS["b1"].stamp)
    dim = wh.read("dwh.dim_customer")
    a = sorted(r.customer_key for r in dim.collect())
    b = sorted(r.customer_key for r in wh.read("dwh.dim_customer").collect())
    assert a == b and len(set(a)) == len(a) and all(len(k) == 36 for k in a)
    # every fact key points at a stored dimension key
    fact = wh.read("dwh.fact_sales")
    assert fact.join(dim, "customer_key", "left_anti").count() == 0


def test_w1_into_database_then_w2(spark, tmpdir_path):
    """W1 into the source database (truncate + insert, twice: no duplicates),
    then W2 reads it over JDBC."""
    url = derby_url("w1target")
    files = write_files(os.path.join(tmpdir_path, "in"))
    job_load_csv(spark, None, files, jdbc_url=url, jdbc_properties=DERBY)
    job_load_csv(spark, None, files, jdbc_url=url, jdbc_properties=DERBY)
    back = read_jdbc_table(spark, url, "customers", properties=DERBY)
    assert back.count() == 4
    wh = Warehouse(spark, os.path.join(tmpdir_path, "wh"), db_prefix="w1db_")
    job_psql(spark, wh, url, "2024-03-13 03:00:00", DERBY, partitions=2)
    assert wh.read("dwh.fact_sales").count() == 4


def test_landing_copies_bytes(spark, tmpdir_path):
    """Blanks and quoted line breaks arrive as sent; a short row raises."""
    from ledgerline.plans.profiles import GCP
    from ledgerline.sources.landing import batch_view, land_files
    from ledgerline.sources.schemas import source_schema
    landing, schema = os.path.join(tmpdir_path, "landing"), source_schema("stores", GCP)
    made = "2024-03-04 08:15:00"
    body = f'{HEADERS["stores"]}\n3,"  Dock  ","two\nlines",{made},{made}\n'
    paths = write_files(os.path.join(tmpdir_path, "a"), {"stores": body})
    land_files(spark, paths, landing, "20240313030000")
    with open(os.path.join(landing, "20240313030000", "stores", "stores.csv")) as fh:
        assert fh.read() == body
    got = batch_view(spark, landing, "20240313030000", "stores", schema, multi_line=True).collect()
    assert [(r.name, r.location) for r in got] == [("  Dock  ", "two\nlines")]
    with pytest.raises(Exception, match="exists|stores.csv"):
        land_files(spark, paths, landing, "20240313030000")
    short = write_files(os.path.join(tmpdir_path, "b"), {"stores": f'{HEADERS["stores"]}\n4,Short\n'})
    land_files(spark, short, landing, "20240314030000")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        batch_view(spark, landing, "20240314030000", "stores", schema).collect()


def test_w1_takes_quoted_line_breaks_and_rejects_unknown_columns(spark, tmpdir_path):
    wh = Warehouse(spark, os.path.join(tmpdir_path, "wh"), db_prefix="ml_")
    made = "2024-03-04 08:15:00"
    files = write_files(os.path.join(tmpdir_path, "in"), {"stores": f'{HEADERS["stores"]}\n3,Dock,"two\nlines",{made},{made}\n'})
    job_load_csv(spark, wh, files, multi_line=True)
    assert wh.read("public.stores").first().location == "two\nlines"
    files = write_files(os.path.join(tmpdir_path, "in"), {"stores": f'{HEADERS["stores"]},colour\n3,Dock,x,{made},{made},red\n'})
    with pytest.raises(ValueError, match="colour"):
        job_load_csv(spark, wh, files)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_null_keys_do_not_meet_in_one_task(spark, how):
    from pyspark.sql import functions as F

    from ledgerline.operators.lookup import salted_join
    left = spark.range(20_000).select("id", F.when(F.col("id") % 10 == 0, F.col("id") % 7).alias("k"))
    right = spark.range(7).selectExpr("id AS rk", "id * 2 AS v")
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = salted_join(left, right, "k", "rk", how, 100, ["id"])
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert out.count() == (20_000 if how == "left" else 2_000)
        assert max(sizes) <= sum(sizes) / 3
        assert out.where("k IS NOT NULL AND v <> 2 * k").count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)

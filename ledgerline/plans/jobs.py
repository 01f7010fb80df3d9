"""Whole jobs. The driver only sequences steps and swaps views; every
step is a distributed DataFrame job.

* W1 ``job_load_csv``: CSV (by name) -> clean -> gate -> full refresh.
* W2 ``job_psql``: JDBC copy of the source tables -> ``job_warehouse``.
* W3 ``job_gcp``: stamp -> land files -> by-position views + row gates ->
  ``job_warehouse``.
* ``job_warehouse``: per dimension stage -> gates -> SCD2 -> touched partitions;
  then fact lookup -> stage -> gate -> upsert -> touched partitions. Dimensions
  before the fact is a hard barrier.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.timestamps import new_stamp, stamp_to_text
from ledgerline.operators import gates as G
from ledgerline.operators.lookup import lookup_keys
from ledgerline.operators.scd2 import dim_schema, scd2_delta
from ledgerline.operators.staging import stage_dimension, stage_sales
from ledgerline.operators.zorder import curve
from ledgerline.operators.upsert import fact_schema, upsert_fact
from ledgerline.plans.profiles import DIMENSIONS, GCP, PSQL, PSQL_LENGTHS, DimSpec, Profile
from ledgerline.operators.sequence import KeySequence
from ledgerline.plans.parallel import run_parallel
from ledgerline.plans.tables import SLOT, Warehouse
from ledgerline.sources.csv import force_all_columns, read_csv_by_name
from ledgerline.sources.jdbc import copy_jdbc_table, write_jdbc_table
from ledgerline.sources.landing import batch_view, land_files
from ledgerline.sources.quarantine import accepted, judged, rejected
from ledgerline.sources.registry import TableSpec, load_registry
from ledgerline.session import materialize
from ledgerline.sources.schemas import SOURCE_TABLES, source_schema

# Schema names per profile.
SCHEMAS = {"psql": ("public", "stage", "dwh"), "gcp": ("staging", "staging", "dwh")}


@dataclass
class RunResult:
    stamp: str
    run_ts: str
    written: dict  # rows written by table


def job_load_csv(spark: SparkSession, wh: Warehouse | None, files: dict[str, str],
                 profile: Profile = PSQL, db: str = "public", jdbc_url: str | None = None,
                 jdbc_properties: dict | None = None, multi_line: bool = False,
                 schemas: dict[str, T.StructType] | None = None, quarantine: bool = False) -> dict[str, int]:
    """CSV by name -> cleaning -> full refresh of each source table, into
    warehouse tables or, with ``jdbc_url``, into the source database
    (TRUNCATE keeps the table definition, then batched INSERTs from every
    task). Every file is parsed and gated before anything is replaced.
    ``multi_line``: quoted fields may hold line breaks (still read by splits).
    ``quarantine``: rows that do not fit the schema go to ``<table>__rejected``
    instead of stopping the load."""
    schemas = schemas or {t: source_schema(t, profile) for t in files}
    if quarantine:
        wh.ensure_schemas(db)
        frames = {}
        for t, path in files.items():
            text = read_csv_by_name(spark, path, multi_line=multi_line)
            rows = judged(text, schemas[t], required=[f.name for f in schemas[t].fields if not f.nullable])
            wh.replace_table(rejected(rows), f"{db}.{t}__rejected")
            frames[t] = accepted(rows, schemas[t])
    else:
        frames = {t: read_csv_by_name(spark, path, schemas[t], multi_line=multi_line) for t, path in files.items()}
    if jdbc_url is not None:
        out = {}
        for table, df in frames.items():
            out[table] = force_all_columns(df)  # parses every column: FAILFAST applies
            if not out[table]:
                raise G.GateError(f"{table}: no rows in {files[table]}")
        for table, df in frames.items():
            write_jdbc_table(df, jdbc_url, table, jdbc_properties, truncate=True)
        return out
    wh.ensure_schemas(db)
    aside = {t: wh.write_aside(df, f"{db}.{t}") for t, df in frames.items()}  # one pass: parse, count, write
    for table, (_, counted) in aside.items():
        G.require_observed(counted, f"{table} ({files[table]})", rows=True)
    for table, (path, _) in aside.items():
        wh.point_at(f"{db}.{table}", path, frames[table].schema)
    return {t: counted["n_rows"] for t, (_, counted) in aside.items()}


def _source_gates(df: DataFrame, table: str, key: str) -> int:
    return G.require_batch_key(df, [key], table)


# Columns that may not be NULL, beside the surrogate key.
REQUIRED = ("id", "source_system")


def dim_table(spec: DimSpec, profile: Profile) -> str:
    return f"{SCHEMAS[profile.name][2]}.dim_{spec.name}"


def ensure_dim(wh: Warehouse, spec: DimSpec, profile: Profile) -> str:
    """K5 / K6: the dimension's target, if absent."""
    name, schema = dim_table(spec, profile), dim_schema(spec, profile)
    lengths = {c: n for c, n in PSQL_LENGTHS.items() if c in schema.names} if profile.name == "psql" else {}
    wh.create_table(name, schema.add(SLOT, "string"), ("is_active", SLOT), lengths,
                    {"is_active": "true", "effective_start_date": "current_timestamp()"})
    return name


def load_dimension(wh: Warehouse, spec: DimSpec, profile: Profile, staged: DataFrame, run_ts: str, stamp: str,
                   deep_gates: bool = False) -> int:
    """One staged batch into a stored dimension: only touched partitions are
    written. Returns the rows written (0: nothing opened, nothing touched)."""
    name = ensure_dim(wh, spec, profile)
    wh.finish_pending(name)
    dim = wh.spark.table(wh.q(name))
    sequence = profile.dim_key_kind == "sequence"
    seq = KeySequence(wh.last_key(name, spec.key_col) if sequence else None)
    delta = scd2_delta(dim, staged, spec, profile, run_ts, stamp, SLOT, wh.slots(name), seq, wh.partitions())
    if delta is None:
        return 0
    required = (spec.key_col, *REQUIRED)
    lengths = {c: n for c, n in PSQL_LENGTHS.items() if c in dim.columns} if profile.name == "psql" else {}
    cluster = [spec.key_col if c == "KEY" else c for c in profile.dim_cluster_by]
    pending, counted = wh.write_pending(delta, name, ["is_active", SLOT, *profile.dim_partition_by, *cluster, "id"],
                                        G.observed_metrics(required, lengths))
    G.require_observed(counted, spec.name, required, lengths)  # C1, C5
    if deep_gates:
        G.require_unique(pending, [spec.key_col], spec.name)
        G.require_single_active(pending, profile.match_keys(spec), spec.name)
    wh.publish(name, {f"sequence.{spec.key_col}": str(seq.value)} if sequence else {})
    return counted["n_rows"]


def ensure_fact(wh: Warehouse, profile: Profile) -> str:
    name = f"{SCHEMAS[profile.name][2]}.fact_sales"
    wh.create_table(name, fact_schema(profile), ("sale_date_key",))
    return name


def _on_days(df: DataFrame, days: list) -> DataFrame:
    """Rows of the partitions ``days`` (NULL is a day like any other)."""
    return df.filter(F.col("sale_date_key").isin([d for d in days if d is not None])
                     | (F.col("sale_date_key").isNull() if None in days else F.lit(False)))


def unchanged_sales(fact: DataFrame, staged: DataFrame, profile: Profile) -> DataFrame:
    """Ids of staged sales that stand in the fact with the same values in every
    column the merge would update, but for the load time. Where the merge moves
    rows between days, only the staged days are read."""
    cols = [c for c in profile.fact_update_cols if c != "dwh_load_date"]
    if "sale_date_key" in cols:
        fact = _on_days(fact, [r[0] for r in staged.select("sale_date_key").distinct().collect()])
    s = staged.select(F.col("id").alias("_id"), *[F.col(c).cast(fact.schema[c].dataType).alias(f"_s_{c}") for c in cols])
    same = F.col("id") == F.col("_id")
    for c in cols:
        same &= F.col(c).eqNullSafe(F.col(f"_s_{c}"))
    return fact.join(s, same).select("id")


def merge_fact_partitions(spark: SparkSession, wh: Warehouse, profile: Profile, staged: DataFrame, run_ts: str,
                          skip_unchanged: bool = False) -> int:
    """Fact upsert that rewrites only the touched ``sale_date_key`` partitions.

    Touched = dates of the staged rows and current dates of the fact rows they
    match (a gcp update may move a row to another date). The dates reach the
    driver: no more than the catalog's partitions. ``skip_unchanged``: staged
    rows that would change nothing but ``dwh_load_date`` are left out, so an
    unchanged batch writes no partition (and leaves the former load time).
    Returns the rows written.
    """
    name, schema = ensure_fact(wh, profile), fact_schema(profile)
    wh.finish_pending(name)
    fact = wh.read(name).select(*schema.names)
    sequence = profile.fact_key_kind == "sequence"
    if skip_unchanged:
        staged = materialize(staged.join(unchanged_sales(fact, staged, profile), "id", "left_anti"))
    # read three times: here, and by the merge for its new rows in the pass that finds ranges and the one that writes
    held = materialize(fact.select("id", "sale_date_key").join(staged.select("id"), "id", "left_semi"))
    days = [r[0] for r in staged.select("sale_date_key").unionByName(held.select("sale_date_key")).distinct().collect()]
    if not days:
        return 0
    start = wh.last_key(name, "sales_key") if sequence else 0
    merged = upsert_fact(_on_days(fact, days), staged, profile, run_ts, key_start=start, held=held.select("id"))
    required, largest = ("sales_key", *REQUIRED), ("sales_key",) if sequence else ()
    # K8: along a Z-order curve of the dimension keys, so that each of them skips row groups
    # (sales_key begins with the run's second, so its quantiles tell no rows apart)
    by = [curve(staged, list(profile.fact_cluster_by[1:]))] if profile.fact_cluster_by else []
    pending, counted = wh.write_pending(merged, name, ["sale_date_key", *by, "id"],
                                        G.observed_metrics(required, largest=largest))
    G.require_observed(counted, "fact_sales", required)
    G.require_unique(pending, ["id"], name)  # C3: moved ids have all their dates here
    left = {r[0] for r in pending.select("sale_date_key").distinct().collect()}
    emptied = [f"`sale_date_key` = {'null' if d is None else f'DATE{str(d)!r}'}" for d in days if d not in left]
    # every new key lies in the rewritten partitions
    last = {"sequence.sales_key": str(max(start, counted["largest.sales_key"] or 0))} if sequence else {}
    wh.publish(name, last, [] if profile.name == "psql" else emptied)
    return counted["n_rows"]


def job_warehouse(spark: SparkSession, wh: Warehouse, profile: Profile,
                  sources: dict[str, DataFrame], run_ts: str, stamp: str,
                  deep_gates: bool = False, parallel: bool = True, skip_unchanged: bool = False) -> RunResult:
    _, stage_db, dwh_db = SCHEMAS[profile.name]
    wh.ensure_schemas(stage_db, dwh_db)
    # every batch gate passes before anything is written
    keys_of = {spec.source_table: spec.natural_id for spec in DIMENSIONS.values()}
    keys_of["sales"] = "sale_id"
    run_parallel({t: (lambda t=t: _source_gates(sources[t], t, keys_of[t])) for t in keys_of})

    def dimension(spec):
        staged = wh.stage_table(stage_dimension(sources[spec.source_table], spec, profile, run_ts, stamp),
                                f"{stage_db}.dim_{spec.name}")
        return load_dimension(wh, spec, profile, staged, run_ts, stamp, deep_gates)

    # the dimensions are independent: their jobs run side by side
    written = {dim_table(DIMENSIONS[n], profile): rows for n, rows in run_parallel(
        {n: (lambda spec=spec: dimension(spec)) for n, spec in DIMENSIONS.items()}, max_workers=None if parallel else 1).items()}
    dims = {n: wh.read(dim_table(spec, profile)) for n, spec in DIMENSIONS.items()}
    staged = wh.stage_table(stage_sales(lookup_keys(sources["sales"], dims, profile), profile, run_ts, stamp),
                            f"{stage_db}.fact_sales")
    G.require_unique(staged, ["id"], "staged sales")  # C4
    written[f"{dwh_db}.fact_sales"] = merge_fact_partitions(spark, wh, profile, staged, run_ts, skip_unchanged)
    return RunResult(stamp, run_ts, written)


def read_fact(wh: Warehouse, profile: Profile) -> DataFrame:
    return wh.read(ensure_fact(wh, profile)).select(*fact_schema(profile).names)


def job_psql(spark: SparkSession, wh: Warehouse, url: str, run_ts: str,
             properties: dict | None = None, partitions: int = 8,
             tables: tuple[str, ...] = SOURCE_TABLES) -> RunResult:
    """Copy every source table over JDBC (full replace), then load."""
    src_db = SCHEMAS["psql"][0]
    wh.ensure_schemas(src_db)
    keys = {"customers": "customer_id", "products": "product_id", "stores": "store_id",
            "sales": "sale_id"}
    for t in tables:
        copy_jdbc_table(spark, url, t, lambda df, t=t: wh.replace_table(df, f"{src_db}.{t}"), keys.get(t), partitions,
                        properties=properties)
    sources = {t: wh.read(f"{src_db}.{t}") for t in tables}
    stamp = datetime.strptime(run_ts, "%Y-%m-%d %H:%M:%S").strftime("%Y%m%d%H%M%S")
    return job_warehouse(spark, wh, PSQL, sources, run_ts, stamp)


def job_load_csv_registry(spark: SparkSession, wh: Warehouse, registry_path: str, data_dir: str,
                          profile: Profile = PSQL, **kw) -> dict[str, int]:
    """W1 over the tables of a registry: one ``<data_dir>/<table>.csv`` each,
    cast to the schema that the registry declares."""
    registry = load_registry(registry_path)
    return job_load_csv(spark, wh, {name: f"{data_dir.rstrip('/')}/{name}.csv" for name in registry}, profile,
                        schemas={name: spec.schema for name, spec in registry.items()}, **kw)


def job_gcp(spark: SparkSession, wh: Warehouse, files: dict[str, str], landing_root: str,
            now: datetime | None = None,
            registry: dict[str, TableSpec] | None = None) -> RunResult:
    """One stamp per run; the stamp is also the load time. ``registry``
    (S4) supplies the by-position schemas; default: the declared ones."""
    stamp = new_stamp(now)
    land_files(spark, files, landing_root, stamp)
    return job_gcp_landed(spark, wh, landing_root, stamp, tuple(files), registry)


def job_gcp_landed(spark: SparkSession, wh: Warehouse, landing_root: str, stamp: str,
                   tables: tuple[str, ...] = SOURCE_TABLES,
                   registry: dict[str, TableSpec] | None = None) -> RunResult:
    """The part of W3 after landing: by-position views, row gates, load."""
    sources = {}
    for t in tables:
        schema = registry[t].schema if registry else source_schema(t, GCP)
        df = batch_view(spark, landing_root, stamp, t, schema, view=f"src_{t}")
        sources[t] = df  # K9 row gate: part of the batch key gate in job_warehouse
    return job_warehouse(spark, wh, GCP, sources, stamp_to_text(stamp), stamp)

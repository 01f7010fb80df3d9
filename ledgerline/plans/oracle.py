"""DuckDB oracle SQL for every registered query.

each batch is one chain of CTEs (stage -> join to active -> close -> open),
and the fact is a FULL OUTER JOIN per day. Tables (customer, part, ...) are
the driver's pre-registered views.
"""

from __future__ import annotations

from ledgerline.plans.profiles import DIMENSIONS, GCP, PSQL, DimSpec, Profile, with_rule
from ledgerline.sources.retail import RUNS, SOURCE_TS, TOUCHED_TS


def _t(text: str) -> str:
    return f"TIMESTAMP '{text}'"


def _sqltype(dt) -> str:
    s = dt.simpleString()
    return {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE",
            "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN"}.get(
        s, s.upper())


_BASE = {
    "customers": ("customer", "c_custkey", "c_name", "c_mktsegment", None),
    "products": ("part", "p_partkey", "p_name", "p_type", "p_retailprice"),
    "stores": ("supplier", "s_suppkey", "s_name", "CAST(s_nationkey AS VARCHAR)", None),
}
_NAMES = {"customers": ("customer_id", "name", "address"),
          "products": ("product_id", "name", "category"),
          "stores": ("store_id", "name", "location")}


def source_sql(table: str, batch: str, p: Profile) -> str:
    tbl, k, name, attr, price = _BASE[table]
    idc, namec, attrc = _NAMES[table]
    if batch == "b1":
        where, n = f"{k} % 10 <> 0", name
        a = f"CASE WHEN {k} % 11 = 0 THEN NULL ELSE {attr} END"
        upd = _t(SOURCE_TS)
    else:
        where = "TRUE" if batch == "b2" else f"{k} % 17 <> 0"
        n = f"CASE WHEN {k} % 5 = 1 THEN {name} || '!' ELSE {name} END"
        if batch == "b2":
            a = f"CASE WHEN {k} % 13 = 0 THEN NULL WHEN {k} % 7 = 0 THEN 'MOVED' ELSE {attr} END"
            upd = _t(SOURCE_TS)
        else:
            a = (f"CASE WHEN {k} % 7 = 0 THEN 'MOVED AGAIN' WHEN {k} % 13 = 0 THEN NULL "
                 f"ELSE {attr} END")
            upd = f"CASE WHEN {k} % 3 = 0 THEN {_t(TOUCHED_TS)} ELSE {_t(SOURCE_TS)} END"
    cols = [f"CAST({k} AS {_sqltype(p.id_type)}) AS {idc}", f"{n} AS {namec}", f"{a} AS {attrc}"]
    if price:
        cols.append(f"CAST(CAST({price} AS DECIMAL(10,2)) AS {_sqltype(p.money_type)}) AS price"
                    if p.name == "psql" else f"CAST({price} AS DOUBLE) AS price")
    cols += [f"{_t(SOURCE_TS)} AS created_at", f"{upd} AS updated_at"]
    return f"SELECT {', '.join(cols)} FROM {tbl} WHERE {where}"


def _load(p: Profile, batch: str) -> str:
    run = RUNS[batch]
    if p.name == "gcp":
        return f"strptime('{run.stamp}', '%Y%m%d%H%M%S')"
    return _t(run.run_ts)


def stage_sql(spec: DimSpec, p: Profile, batch: str) -> str:
    src = source_sql(spec.source_table, batch, p)
    cols = [f"'{p.source_system}_' || CAST({spec.natural_id} AS VARCHAR) AS id",
            f"'{p.source_system}' AS source_system",
            f"CAST({spec.natural_id} AS {_sqltype(p.id_type)}) AS {spec.natural_id}"]
    for a in spec.attrs:
        if a.kind == "money":
            v = "TRY_CAST(price AS DECIMAL(38,9))" if p.name == "gcp" else "price"
            cols.append(f"{v} AS {a.target}")
        else:
            cols.append(f"{a.source} AS {a.target}")
    cols.append("created_at")
    if p.writes_created:
        cols.append("CAST(created_at AS DATE) AS created_date")
    cols += ["updated_at", f"{_load(p, batch)} AS dwh_load_date"]
    return f"SELECT {', '.join(cols)} FROM ({src}) src"


def _dim_cols(spec: DimSpec, p: Profile) -> list[tuple[str, str]]:
    money = "DECIMAL(10,2)"
    cols = [(spec.key_col, _sqltype(p.dim_key_type)), ("id", "VARCHAR"),
            ("source_system", "VARCHAR"), (spec.natural_id, _sqltype(p.id_type))]
    cols += [(a.target, money if a.kind == "money" else "VARCHAR") for a in spec.attrs]
    cols.append(("created_at", "TIMESTAMP"))
    if p.writes_created:
        cols.append(("created_date", "DATE"))
    cols += [("updated_at", "TIMESTAMP"), ("dwh_load_date", "TIMESTAMP"),
             ("is_active", "BOOLEAN"), ("effective_start_date", "TIMESTAMP"),
             ("effective_end_date", "TIMESTAMP")]
    return cols


def _empty_dim(spec: DimSpec, p: Profile) -> str:
    cols = ", ".join(f"CAST(NULL AS {t}) AS {c}" for c, t in _dim_cols(spec, p))
    return f"SELECT {cols} WHERE FALSE"


def _pred(spec: DimSpec, p: Profile) -> str:
    terms = []
    for c in p.tracked(spec):
        kind = spec.attr(c).kind if c in spec.attr_cols else "time"
        if p.change_rule == "padded":
            pad = "0" if kind == "money" else "''"
            terms.append(f"{c} <> _o_{c}" if kind == "time" else f"{c} <> COALESCE(_o_{c}, {pad})")
        elif p.change_rule == "hash":
            terms.append(f"_o_{c} <> {c}")
        else:
            terms.append(f"_o_{c} IS DISTINCT FROM {c}")
    return "(" + " OR ".join(terms) + ")"


def _keys(spec: DimSpec, p: Profile) -> list[str]:
    return p.match_keys(spec)


def scd2_ctes(spec: DimSpec, p: Profile, batch: str, prev: str, out: str) -> list[str]:
    """CTEs turning dimension ``prev`` into ``out`` after ``batch``."""
    run = RUNS[batch]
    keys = _keys(spec, p)
    olds = list(dict.fromkeys(p.tracked(spec) + spec.attr_cols))
    on = " AND ".join(f"d.{k} = s.{k}" for k in keys)
    hit_col = f"d.{keys[0]}"
    ctes = [
        f"{out}_stg AS ({stage_sql(spec, p, batch)})",
        f"{out}_j AS (SELECT s.*, ({hit_col} IS NOT NULL) AS _hit, "
        + ", ".join(f"d.{c} AS _o_{c}" for c in olds)
        + f" FROM {out}_stg s LEFT JOIN (SELECT * FROM {prev} WHERE is_active = TRUE) d ON {on})",
        f"{out}_o AS (SELECT * FROM {out}_j WHERE NOT _hit OR COALESCE(_hit AND {_pred(spec, p)}, FALSE))",
    ]
    scope = "TRUE" if p.close_scope == "all_versions" else "COALESCE(d.is_active, FALSE)"
    close = f"(COALESCE(c._close, FALSE) AND {scope})"
    con = " AND ".join(f"c.{k} = d.{k}" for k in keys)
    ctes.append(
        f"{out}_kept AS (SELECT d.* REPLACE ("
        f"CASE WHEN {close} THEN FALSE ELSE d.is_active END AS is_active, "
        f"CASE WHEN {close} THEN {_t(run.run_ts)} ELSE d.effective_end_date END AS effective_end_date)"
        f" FROM {prev} d LEFT JOIN (SELECT DISTINCT {', '.join(keys)}, TRUE AS _close "
        f"FROM {out}_o WHERE _hit) c ON {con})")
    sel = []
    for c, typ in _dim_cols(spec, p):
        if c == spec.key_col:
            if p.dim_key_kind == "hash":
                v = f"md5(id || '|' || '{run.stamp}')"
            else:
                v = (f"(SELECT COALESCE(MAX({c}), 0) FROM {prev}) + "
                     f"ROW_NUMBER() OVER (ORDER BY {spec.natural_id})")
        elif c in spec.attr_cols:
            kind = spec.attr(c).kind
            v = f"COALESCE({c}, _o_{c})" if (p.carry_forward and kind == "text") else c
        elif c == "created_at":
            v = "created_at" if p.writes_created else "NULL"
        elif c == "dwh_load_date" and spec.name == "store" and p.store_load_date_is_run_ts:
            v = _t(run.run_ts)
        elif c == "is_active":
            v = "TRUE"
        elif c == "effective_start_date":
            v = _t(run.run_ts)
        elif c == "effective_end_date":
            v = "NULL"
        else:
            v = c
        sel.append(f"CAST({v} AS {typ}) AS {c}")
    ctes.append(f"{out}_new AS (SELECT {', '.join(sel)} FROM {out}_o)")
    ctes.append(f"{out} AS (SELECT * FROM {out}_kept UNION ALL SELECT * FROM {out}_new)")
    return ctes


def dim_chain(spec: DimSpec, p: Profile, batches: tuple[str, ...], prefix: str) -> tuple[list[str], str]:
    ctes = [f"{prefix}0 AS ({_empty_dim(spec, p)})"]
    prev = f"{prefix}0"
    for i, b in enumerate(batches, 1):
        out = f"{prefix}{i}"
        ctes += scd2_ctes(spec, p, b, prev, out)
        prev = out
    return ctes, prev


def _with(ctes: list[str], final: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + final


def scd2_sql(dim: str, p: Profile, batches=("b1", "b2")) -> str:
    ctes, last = dim_chain(DIMENSIONS[dim], p, batches, "d")
    return _with(ctes, f"SELECT * FROM {last}")


def changed_sql(p: Profile) -> str:
    spec = DIMENSIONS["customer"]
    ctes, _ = dim_chain(spec, p, ("b1",), "d")
    ctes += scd2_ctes(spec, p, "b2", "d1", "d2")
    return _with(ctes, "SELECT id, _hit AS has_active, "
                 f"(_hit AND COALESCE({_pred(spec, p)}, FALSE)) AS changed FROM d2_j")


def carry_forward_sql() -> str:
    spec = DIMENSIONS["customer"]
    ctes, _ = dim_chain(spec, PSQL, ("b1", "b2"), "d")
    return _with(ctes, "SELECT * FROM d2_new")


def stage_dim_sql(dim: str, p: Profile) -> str:
    return stage_sql(DIMENSIONS[dim], p, "b2")


# ---- sales and fact -------------------------------------------------------

def sales_all_sql(p: Profile) -> str:
    idt = _sqltype(p.id_type)
    money = "DECIMAL(10,2)" if p.name == "psql" else "DOUBLE"
    return (f"SELECT CAST(o.o_orderkey AS {idt}) AS sale_id, CAST(o.o_custkey AS {idt}) AS customer_id, "
            f"CAST(l.product_id AS {idt}) AS product_id, CAST(l.store_id AS {idt}) AS store_id, "
            f"o.o_orderdate AS sale_date, CAST(CAST(trunc(l.qty) AS INTEGER) AS {idt}) AS quantity, "
            f"CAST(CAST(o.o_totalprice AS DECIMAL(10,2)) AS {money}) AS total_amount, "
            f"{_t(SOURCE_TS)} AS created_at, {_t(SOURCE_TS)} AS updated_at "
            "FROM orders o JOIN (SELECT l_orderkey, MIN(l_partkey) AS product_id, "
            "MIN(l_suppkey) AS store_id, SUM(l_quantity) AS qty FROM lineitem GROUP BY l_orderkey) l "
            "ON o.o_orderkey = l.l_orderkey")


def sales_batch_sql(p: Profile, batch: str) -> str:
    s = sales_all_sql(p)
    if batch == "all":
        return s
    if batch == "b1":
        return f"SELECT * FROM ({s}) s WHERE sale_id % 4 <> 0"
    idt = _sqltype(p.id_type)
    return (f"SELECT * REPLACE (CASE WHEN sale_id % 6 = 0 THEN sale_date + INTERVAL 1 DAY "
            f"ELSE sale_date END AS sale_date, CAST(quantity + 1 AS {idt}) AS quantity, "
            f"{_t('2024-01-02 00:00:00')} AS updated_at) FROM ({s}) s WHERE sale_id % 3 = 0 OR sale_id % 4 = 0")


def fact_stage_ctes(p: Profile, batch: str, dims: dict[str, str], out: str,
                    sales: str | None = None) -> list[str]:
    how = "LEFT JOIN" if p.lookup_how == "left" else "JOIN"
    joins = []
    for name, alias in (("customer", "dc"), ("product", "dp"), ("store", "ds")):
        spec = DIMENSIONS[name]
        extra = f" AND source_system = '{p.source_system}'" if p.lookup_on_source_system else ""
        joins.append(f"{how} (SELECT {spec.natural_id} AS _lk, {spec.key_col} FROM {dims[name]} "
                     f"WHERE is_active = TRUE{extra}) {alias} ON s.{spec.natural_id} = {alias}._lk")
    amount = "CAST(total_amount AS DECIMAL(38,9))" if p.name == "gcp" else "total_amount"
    upd = "sale_date" if p.fact_updated_at_from_sale_date else "updated_at"
    cols = [f"'{p.source_system}_' || CAST(sale_id AS VARCHAR) AS id",
            f"'{p.source_system}' AS source_system", "sale_id AS sales_id",
            "customer_key", "product_key", "store_key", "sale_date AS sale_time",
            "CAST(sale_date AS DATE) AS sale_date_key", "quantity", f"{amount} AS total_amount"]
    if p.name == "gcp":
        cols.append("created_at")
    cols += [f"{upd} AS updated_at", f"{_load(p, batch)} AS dwh_load_date"]
    return [f"{out}_k AS (SELECT s.*, dc.customer_key, dp.product_key, ds.store_key "
            f"FROM ({sales_batch_sql(p, sales or batch)}) s {' '.join(joins)})",
            f"{out} AS (SELECT {', '.join(cols)} FROM {out}_k)"]


def _fact_cols(p: Profile) -> list[tuple[str, str]]:
    key = _sqltype(p.dim_key_type)
    idt = _sqltype(p.id_type)
    cols = [("sales_key", _sqltype(p.fact_key_type)), ("sales_id", idt), ("id", "VARCHAR"),
            ("source_system", "VARCHAR"), ("customer_key", key), ("product_key", key),
            ("store_key", key), ("sale_time", "TIMESTAMP"), ("sale_date_key", "DATE"),
            ("quantity", idt), ("total_amount", "DECIMAL(10,2)"), ("created_at", "TIMESTAMP")]
    if p.fact_has_created_date:
        cols.append(("created_date", "DATE"))
    cols += [("updated_at", "TIMESTAMP"), ("dwh_load_date", "TIMESTAMP")]
    return cols


FACT_INSERT = ("sales_id", "id", "source_system", "customer_key", "product_key", "store_key",
               "sale_time", "sale_date_key", "quantity", "total_amount", "updated_at",
               "dwh_load_date")


def fact_merge_ctes(p: Profile, batch: str, prev: str, stg: str, out: str) -> list[str]:
    run = RUNS[batch]
    stg_cols = {"id", "source_system", "sales_id", "customer_key", "product_key", "store_key",
                "sale_time", "sale_date_key", "quantity", "total_amount", "updated_at",
                "dwh_load_date"} | ({"created_at"} if p.name == "gcp" else set())
    sel = ["t._t AS _t", "t.sales_key AS _old_key"]
    for c, typ in _fact_cols(p):
        if c == "sales_key":
            continue
        if c == "id":
            v = "COALESCE(t.id, s.id)"
        elif c in p.fact_update_cols and c in stg_cols:
            v = f"CASE WHEN s._s THEN s.{c} ELSE t.{c} END"
        elif c in FACT_INSERT and c in stg_cols:
            v = f"CASE WHEN t._t THEN t.{c} ELSE s.{c} END"
        else:
            v = f"t.{c}"
        sel.append(f"CAST({v} AS {typ}) AS {c}")
    if p.fact_key_kind == "epoch":
        newkey = f"CAST(CAST(epoch({_t(run.run_ts)}) AS BIGINT) AS VARCHAR) || '_' || id"
        key = f"CASE WHEN _t THEN _old_key ELSE {newkey} END"
    else:
        key = (f"CASE WHEN _t THEN _old_key ELSE (SELECT COALESCE(MAX(sales_key), 0) FROM {prev}) + "
               f"ROW_NUMBER() OVER (PARTITION BY _t IS NULL ORDER BY sales_id) END")
    names = [c for c, _ in _fact_cols(p)]
    ktype = _sqltype(p.fact_key_type)
    final = ", ".join(f"CAST({key} AS {ktype}) AS sales_key" if c == "sales_key" else c
                      for c in names)
    return [f"{out}_m AS (SELECT {', '.join(sel)} FROM (SELECT *, TRUE AS _t FROM {prev}) t "
            f"FULL OUTER JOIN (SELECT *, TRUE AS _s FROM {stg}) s ON t.id = s.id)",
            f"{out} AS (SELECT {final} FROM {out}_m)"]


def _empty_fact(p: Profile) -> str:
    cols = ", ".join(f"CAST(NULL AS {t}) AS {c}" for c, t in _fact_cols(p))
    return f"SELECT {cols} WHERE FALSE"


def fact_stage_sql(p: Profile) -> str:
    ctes, dims = [], {}
    for name, spec in DIMENSIONS.items():
        c, last = dim_chain(spec, p, ("b1", "b2"), f"{name[0]}d")
        ctes += c
        dims[name] = last
    ctes += fact_stage_ctes(p, "b2", dims, "fs1", sales="all")
    return _with(ctes, "SELECT * FROM fs1")


def fact_sql(p: Profile, batches=("b1", "b2")) -> str:
    ctes = [f"f0 AS ({_empty_fact(p)})"]
    prev_dims = {}
    for name, spec in DIMENSIONS.items():
        ctes.append(f"{name[0]}d0 AS ({_empty_dim(spec, p)})")
        prev_dims[name] = f"{name[0]}d0"
    prev_fact = "f0"
    for i, b in enumerate(batches, 1):
        dims = {}
        for name, spec in DIMENSIONS.items():
            out = f"{name[0]}d{i}"
            ctes += scd2_ctes(spec, p, b, prev_dims[name], out)
            dims[name] = out
        ctes += fact_stage_ctes(p, b, dims, f"fs{i}")
        ctes += fact_merge_ctes(p, b, prev_fact, f"fs{i}", f"f{i}")
        prev_dims, prev_fact = dims, f"f{i}"
    return _with(ctes, f"SELECT * FROM {prev_fact}")


# ---- small ones -----------------------------------------------------------

def clean_values_sql() -> str:
    def clean(v: str) -> str:
        return (f"CASE WHEN {v} = '\\N' THEN NULL "
                f"WHEN regexp_full_match({v}, '[0-9]+[.]?[0-9]*|[.][0-9]+') "
                f"THEN CAST(CAST(trunc(CAST({v} AS DOUBLE)) AS BIGINT) AS VARCHAR) ELSE {v} END")
    raw = {
        "v_qty": "CAST(CAST(l_quantity AS DECIMAL(10,2)) AS VARCHAR)",
        "v_price": "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR)",
        "v_padded": "lpad(CAST(l_linenumber AS VARCHAR), 3, '0')",
        "v_dot_first": "'.' || CAST(l_linenumber AS VARCHAR)",
        "v_dot_last": "CAST(l_orderkey AS VARCHAR) || '.'",
        "v_negative": "'-' || CAST(l_partkey AS VARCHAR)",
        "v_two_dots": "CAST(l_orderkey AS VARCHAR) || '.' || CAST(l_linenumber AS VARCHAR) || '.' "
                      "|| CAST(l_suppkey AS VARCHAR)",
        "v_null_marker": "CASE WHEN l_orderkey % 9 = 0 THEN '\\N' ELSE l_returnflag END",
        "v_timestamp": "CAST(l_shipdate AS VARCHAR)",
        "v_empty": "CASE WHEN l_linenumber % 2 = 0 THEN '' ELSE '.' END",
        "v_big": "CAST(l_orderkey + 9007199254740000 AS VARCHAR)",
    }
    inner = ", ".join(f"{e} AS {n}" for n, e in raw.items())
    outer = ", ".join(f"{clean(n)} AS {n}" for n in raw)
    return (f"SELECT l_orderkey, l_linenumber, {outer} FROM "
            f"(SELECT l_orderkey, l_linenumber, {inner} FROM lineitem) r")


def surrogate_sequence_sql() -> str:
    return ("SELECT o_orderkey, CAST(1000 + ROW_NUMBER() OVER (ORDER BY o_orderkey) AS BIGINT) "
            "AS seq_key FROM orders")


def surrogate_hash_sql() -> str:
    stg = stage_sql(DIMENSIONS["customer"], GCP, "b2")
    return f"SELECT id, md5(id || '|' || '{RUNS['b2'].stamp}') AS customer_key FROM ({stg}) s"


def row_count_sql() -> str:
    parts = [f"SELECT '{t}' AS table_name, CAST(COUNT(*) AS BIGINT) AS n FROM ({source_sql(t, 'b2', PSQL)}) x"
             for t in ("customers", "products", "stores")]
    parts.append(f"SELECT 'sales' AS table_name, CAST(COUNT(*) AS BIGINT) AS n FROM ({sales_all_sql(PSQL)}) x")
    return " UNION ALL ".join(parts)


def constraint_report_sql() -> str:
    def one(name: str, frm: str, keys: list[str]) -> str:
        k = ", ".join(keys)
        nullk = " OR ".join(f"{c} IS NULL" for c in keys)
        return (f"SELECT '{name}' AS table_name, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS n_rows, "
                f"CAST(COALESCE(SUM(CASE WHEN {nullk} THEN n END), 0) AS BIGINT) AS n_null_keys, "
                f"CAST(COUNT(CASE WHEN NOT ({nullk}) AND n > 1 THEN 1 END) AS BIGINT) AS n_duplicate_keys, "
                f"CAST(COALESCE(SUM(CASE WHEN NOT ({nullk}) AND n > 1 THEN n END), 0) AS BIGINT) "
                f"AS n_duplicate_rows FROM (SELECT {k}, COUNT(*) AS n FROM ({frm}) x GROUP BY {k}) g")
    parts = [one(t, source_sql(t, "b2", PSQL), [DIMENSIONS[d].natural_id])
             for t, d in (("customers", "customer"), ("products", "product"), ("stores", "store"))]
    parts.append(one("sales", sales_all_sql(PSQL), ["sale_id"]))
    parts.append(one("lineitem", "SELECT * FROM lineitem", ["l_orderkey", "l_linenumber"]))
    return " UNION ALL ".join(parts)


def typed_target_sql() -> str:
    return ("SELECT c_custkey AS customer_id, c_name AS customer_name, TRUE AS is_active, "
            "TIMESTAMP '2024-01-01 03:00:00' AS effective_start_date, c_mktsegment AS segment FROM customer")


def quarantine_sql() -> str:
    return """
WITH r AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 17 = 0 THEN repeat(p_name, 9) ELSE p_name END AS name,
    CASE WHEN p_partkey % 11 = 0 THEN 'n/a' WHEN p_partkey % 13 = 0 THEN '123456789012.5' WHEN p_partkey % 19 = 0 THEN NULL
         ELSE CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS VARCHAR) END AS price FROM part),
j AS (SELECT *, array_to_string([x FOR x IN [CASE WHEN length(name) > 100 THEN 'name: longer than 100' END,
    CASE WHEN price IS NOT NULL AND TRY_CAST(price AS DECIMAL(10,2)) IS NULL THEN 'price: not decimal(10,2)' END,
    CASE WHEN price IS NULL THEN 'price: null' END] IF x IS NOT NULL], '; ') AS reasons FROM r)
SELECT k AS product_id, reasons = '' AS kept, CASE WHEN reasons = '' THEN CAST(price AS DECIMAL(10,2)) END AS price, reasons FROM j"""


def changed_money_text_sql() -> str:
    return """
WITH r AS (SELECT p_partkey, CAST(p_retailprice AS DECIMAL(10,2)) AS old, CAST(CAST(p_retailprice AS DECIMAL(10,2)) +
    CASE WHEN p_partkey % 3 = 0 THEN 0.004 WHEN p_partkey % 5 = 0 THEN 1 ELSE 0 END AS DECIMAL(38,9)) AS new FROM part)
SELECT p_partkey, old <> new AS by_value, old <> CAST(new AS DECIMAL(10,2)) AS by_rounded,
    md5(CAST(old AS VARCHAR)) <> md5(CAST(new AS VARCHAR)) AS by_text, old <> new AS by_canonical_text,
    old <> CAST(new AS DECIMAL(10,2)) AS by_rounded_text FROM r"""


def csv_quoted_newlines_sql() -> str:
    return """
SELECT CAST(c_custkey AS INTEGER) AS customer_id, c_name AS name,
    CASE c_custkey % 3 WHEN 0 THEN c_mktsegment || chr(10) || 'floor ' || c_custkey
         WHEN 1 THEN 'say "hi",' || chr(10) || c_mktsegment || chr(10) || '"' ELSE c_mktsegment END AS address,
    TIMESTAMP '2024-01-01 00:00:00' AS created_at, TIMESTAMP '2024-01-01 00:00:00' AS updated_at FROM customer"""


def w1_products_sql() -> str:
    return (f"SELECT CAST(product_id AS BIGINT) AS product_id, name, category, CAST(trunc(price) AS DECIMAL(38,9)) AS price, "
            f"created_at, updated_at FROM ({source_sql('products', 'b2', PSQL)}) s")


def registry() -> dict[str, str]:
    q: dict[str, str] = {}
    for prof in (PSQL, GCP):
        for d in ("customer", "product"):
            q[f"stored_{d}_{prof.name}"] = scd2_sql(d, prof, ("b1", "b2", "b3"))
    q["typed_target_defaults"] = typed_target_sql()
    q["quarantine_parts"] = quarantine_sql()
    q["scd2_customer_psql_sql"] = scd2_sql("customer", PSQL)
    q["changed_money_text"] = changed_money_text_sql()
    q["csv_quoted_newlines"] = csv_quoted_newlines_sql()
    q["clustered_sales"] = sales_all_sql(GCP)
    q["w1_products"] = w1_products_sql()
    q["w3_fact_gcp"] = fact_sql(GCP)
    for prof in (PSQL, GCP):  # the written path gives the rows of the rules
        q[f"job_fact_{prof.name}"] = fact_sql(prof)
        q[f"job_customer_{prof.name}"] = scd2_sql("customer", prof)
    q["csv_by_name_customers"] = source_sql("customers", "b2", PSQL)
    q["landed_products"] = source_sql("products", "b2", GCP)
    for prof in (PSQL, GCP):
        for d in ("customer", "product", "store"):
            q[f"stage_{d}s_{prof.name}"] = stage_dim_sql(d, prof)
    q["clean_values"] = clean_values_sql()
    q["changed_psql"] = changed_sql(PSQL)
    q["changed_gcp"] = changed_sql(GCP)
    q["changed_nullsafe"] = changed_sql(with_rule(PSQL, "nullsafe"))
    for prof in (PSQL, GCP):
        for d in ("customer", "product", "store"):
            q[f"scd2_{d}_{prof.name}"] = scd2_sql(d, prof)
    q["scd2_customer_nullsafe"] = scd2_sql("customer", with_rule(PSQL, "nullsafe"))
    q["scd2_three_batches_psql"] = scd2_sql("customer", PSQL, ("b1", "b2", "b3"))
    q["scd2_three_batches_gcp"] = scd2_sql("customer", GCP, ("b1", "b2", "b3"))
    q["scd2_rerun_psql"] = scd2_sql("customer", PSQL, ("b1", "b2", "b2"))
    q["scd2_rerun_gcp"] = scd2_sql("customer", GCP, ("b1", "b2", "b2"))
    q["carry_forward_psql"] = carry_forward_sql()
    q["fact_stage_psql"] = fact_stage_sql(PSQL)
    q["fact_stage_gcp"] = fact_stage_sql(GCP)
    q["fact_upsert_psql"] = fact_sql(PSQL)
    q["fact_merge_gcp"] = fact_sql(GCP)
    for base, variant in (("scd2_customer_psql", "shuffled"), ("scd2_customer_gcp", "shuffled"),
                          ("fact_stage_psql", "salted"), ("fact_stage_gcp", "salted"),
                          ("fact_upsert_psql", "shuffled"), ("fact_merge_gcp", "shuffled")):
        q[f"{base}_{variant}"] = q[base]  # same rows, other physical plan
    q["surrogate_sequence"] = surrogate_sequence_sql()
    q["surrogate_hash"] = surrogate_hash_sql()
    q["row_count_gate"] = row_count_sql()
    q["constraint_report"] = constraint_report_sql()
    return q

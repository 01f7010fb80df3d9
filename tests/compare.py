"""Run registered queries against their DuckDB oracle and compare rows.

Usage: python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import decimal
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duckdb_con(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return v.normalize()
    return v


def normalize(rows: list[tuple], cols: list[str]) -> list[tuple]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, name: str, fn, sql: str, sf_dir: str, con) -> dict:
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    ok_cols = sorted(s_cols) == sorted(d_cols)
    ok_rows = normalize(s_rows, s_cols) == normalize(d_rows, d_cols) if ok_cols else False
    return {"name": name, "cols_ok": ok_cols, "rows_ok": ok_rows, "spark_rows": len(s_rows),
            "oracle_rows": len(d_rows), "spark_sec": round(t1 - t0, 2),
            "spark_cols": s_cols, "oracle_cols": d_cols,
            "spark_sample": normalize(s_rows, s_cols)[:2] if s_rows else [],
            "oracle_sample": normalize(d_rows, d_cols)[:2] if d_rows else []}


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from ledgerline.session import build_session
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    only = set(argv[1:])
    spark = build_session("local[8]", 8)
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duckdb_con(sf_dir)
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if name not in sqls:
            print(f"{name}: no oracle")
            continue
        r = compare(spark, name, fn, sqls[name], sf_dir, con)
        ok = r["cols_ok"] and r["rows_ok"]
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name}: rows {r['spark_rows']}/{r['oracle_rows']} "
              f"{r['spark_sec']}s")
        if not ok:
            print("   spark ", r["spark_cols"], r["spark_sample"])
            print("   oracle", r["oracle_cols"], r["oracle_sample"])
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

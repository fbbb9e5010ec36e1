"""Run registered queries against their DuckDB oracle and report differences.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        if os.environ.get("ORACLE_EXACT"):
            return v + 0.0
        return float(f"{v:.10g}") + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    t = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    ts = time.time() - t
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns differ: spark-only {sorted(set(s_cols) - set(d_cols))} "
                        f"duck-only {sorted(set(d_cols) - set(s_cols))}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows {len(s_rows)} vs {len(d_rows)}")
    if not problems:
        a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
        diff = [(x, y) for x, y in zip(a, b) if x != y]
        if diff:
            problems.append(f"{len(diff)} differing rows; first: spark={diff[0][0]} duck={diff[0][1]}")
    return problems, len(s_rows), ts


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    from __spark_entry__ import oracle_sql, queries

    from firesight.session import local_session
    spark = local_session(os.environ.get("ORACLE_CORES", "8"))
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name in names or sorted(qs):
        if name not in sqls:
            df = qs[name](spark, sf_dir)
            print(f"[rows-only] {name}: {df.count()} rows")
            continue
        try:
            problems, n, ts = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as exc:  # report and continue
            problems, n, ts = [f"error: {str(exc)[:400]}"], -1, 0.0
        status = "OK " if not problems else "BAD"
        bad += bool(problems)
        print(f"[{status}] {name}: {n} rows {ts:.1f}s {'; '.join(problems)}", flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)

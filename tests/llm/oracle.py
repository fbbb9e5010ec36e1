"""Run a DuckDB query over a pandas table or the small test tables."""

import os

import duckdb


def duck(sql, sf_dir=None, **tables):
    con = duckdb.connect()
    if sf_dir:
        for name in os.listdir(sf_dir):
            con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{name}'")
    for name, frame in tables.items():
        con.register("_" + name, frame)
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM _{name}")
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    return names, found.fetchall()


def same(df, names, rows):
    """Equal as bags of rows, columns matched by name."""
    order = sorted(names)
    assert sorted(df.columns) == order
    at = [names.index(c) for c in order]
    mine = sorted((tuple(r[c] for c in order) for r in df.collect()), key=repr)
    assert mine == sorted((tuple(r[i] for i in at) for r in rows), key=repr)

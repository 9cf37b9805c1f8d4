"""Side-by-side comparison of registered queries with their oracle SQL."""

from __future__ import annotations

import math
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp": "TIMESTAMP",
}


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else (0.0 if v == 0 else v)
    return v


def _key(row):
    return tuple((v is None, str(type(v)) if not isinstance(v, (int, float)) else "n", v if v is not None else 0) for v in row)


def compare(spark, con, folder, name, fn, sql):
    """Returns (ok, message)."""
    t0 = time.time()
    df = fn(spark, folder)
    cols = sorted(df.columns)
    got = [tuple(_norm(v) for v in r) for r in df.select(*[f"`{c}`" for c in cols]).collect()]
    took = time.time() - t0
    note = f"{len(got)} rows {took:.1f}s"
    if sql is None:
        return bool(got), f"{note} (rows only)"
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    if sorted(names) != cols:
        return False, f"columns {cols} vs {sorted(names)}"
    order = [names.index(c) for c in cols]
    want = [tuple(_norm(r[i]) for i in order) for r in cur.fetchall()]
    spark_types = dict(df.dtypes)
    odd = [f"{c}:{spark_types[c]}/{types[c]}" for c in cols if SAME_TYPE.get(spark_types[c], spark_types[c].upper()) != types[c]]
    if odd:
        note += " types " + ",".join(odd)
    if len(got) != len(want):
        return False, f"{note}; oracle {len(want)} rows"
    a, b = sorted(got, key=_key), sorted(want, key=_key)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return False, f"{note}; {len(bad)} rows differ, first {cols}: {bad[0][0]} vs {bad[0][1]}"
    return not odd and bool(got), note

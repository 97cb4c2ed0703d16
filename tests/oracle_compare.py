"""Run registered Spark queries and their DuckDB oracle side by side and compare.

Usage: ``python tests/oracle_compare.py [sf_dir] [name ...]``.  Prints one
line per query: row counts, column names/types, and whether the sorted
row multisets are identical.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()

SPARK_TO_DUCK = {"LongType()": "BIGINT", "IntegerType()": "INTEGER", "DoubleType()": "DOUBLE",
                 "StringType()": "VARCHAR", "BooleanType()": "BOOLEAN", "FloatType()": "FLOAT"}


def duck_connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def compare(spark, sf_dir: str, names=None, verbose=True) -> dict:
    import __spark_entry__ as entry

    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck_connect(sf_dir)
    out = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            s_cols = sdf.columns
            s_types = [SPARK_TO_DUCK.get(repr(f.dataType), repr(f.dataType)) for f in sdf.schema.fields]
            s_rows = [tuple(_norm(r[c]) for c in sorted(s_cols)) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            out[name] = {"ok": False, "error": f"spark: {type(e).__name__}: {str(e)[:400]}"}
            print(name, out[name]) if verbose else None
            continue
        t_spark = time.time() - t0
        if name not in sqls:
            out[name] = {"ok": None, "rows": len(s_rows), "spark_sec": round(t_spark, 2)}
            print(f"{name:28s} rows-only {len(s_rows)} rows  {t_spark:.1f}s") if verbose else None
            continue
        try:
            rel = con.sql(sqls[name])
            d_cols = rel.columns
            d_types = [str(t) for t in rel.types]
            d_all = rel.fetchall()
            idx = {c: i for i, c in enumerate(d_cols)}
            d_rows = [tuple(_norm(r[idx[c]]) for c in sorted(d_cols)) for r in d_all]
        except Exception as e:  # noqa: BLE001
            out[name] = {"ok": False, "error": f"duckdb: {type(e).__name__}: {str(e)[:400]}"}
            print(name, out[name]) if verbose else None
            continue
        same_cols = sorted(s_cols) == sorted(d_cols)
        s_map = dict(zip(s_cols, s_types))
        d_map = dict(zip(d_cols, d_types))
        type_diff = {c: (s_map.get(c), d_map.get(c)) for c in set(s_cols) | set(d_cols)
                     if s_map.get(c) != d_map.get(c)}
        key = lambda r: tuple((x is None, str(type(x)), x if not isinstance(x, tuple) else str(x)) for x in r)
        s_sorted, d_sorted = sorted(s_rows, key=key), sorted(d_rows, key=key)
        same_rows = s_sorted == d_sorted
        diff = []
        if not same_rows and same_cols:
            ss, ds = set(map(repr, s_sorted)), set(map(repr, d_sorted))
            diff = [("spark", x) for x in list(ss - ds)[:3]] + [("duck", x) for x in list(ds - ss)[:3]]
        ok = same_cols and same_rows and not type_diff
        out[name] = {"ok": ok, "rows": (len(s_rows), len(d_rows)), "cols": same_cols, "types": type_diff,
                     "diff": diff, "spark_sec": round(t_spark, 2)}
        if verbose:
            print(f"{name:28s} {'OK ' if ok else 'BAD'} rows={len(s_rows)}/{len(d_rows)} cols={same_cols} "
                  f"types={type_diff or 'same'} {t_spark:.1f}s")
            for d in diff:
                print("    ", str(d)[:300])
    return out


if __name__ == "__main__":
    from textlab.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session("local[8]", 8)
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if v.get("ok") is False]
    print("BAD:", bad)

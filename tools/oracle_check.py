"""Run catalog queries on Spark and their oracle SQL on DuckDB; compare.

Usage: python tools/oracle_check.py [sf_dir] [key ...]

Comparison: row count, column names and types, and the sorted multiset of rows with
columns in name order, doubles compared exactly (ORACLE_ROUND=1 rounds to 9 places).
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return ("~null",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("~nan",)
        return ("f", round(v, 9) if os.environ.get("ORACLE_ROUND") else v)
    if isinstance(v, bool):
        return ("b", int(v))
    if isinstance(v, int):
        return ("f", float(v))
    return ("s", str(v))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    out = [tuple(_norm(r[k]) for k in order) for r in rows]
    out.sort()
    return sorted(columns), out


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT"}


def type_diff(df, rel):
    s = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
         for f in df.schema.fields}
    d = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    return {c: (s[c], d.get(c)) for c in s if s[c] != d.get(c)}


def compare(spark, con, sf_dir, key, fn, sql):
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    t2 = time.time()
    sc, sr = rows_of(df.columns, s_rows)
    dc, dr = rows_of(d_cols, d_rows)
    ok = sc == dc and sr == dr
    td = type_diff(df, rel)
    msg = f"types {td} " if td else ""
    ok = ok and not td
    if sc != dc:
        msg += f"columns {sc} vs {dc}"
    elif len(sr) != len(dr):
        msg += f"rows {len(sr)} vs {len(dr)}"
    elif sr != dr:
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        msg += f"values differ, e.g. {diff}"
    return ok, len(sr), t1 - t0, t2 - t1, msg


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:]
    from tastebud.plans import catalog, oracle
    from tastebud.session import build_session
    spark = build_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs = catalog.queries()
    sqls = oracle.SQL
    bad = 0
    for k in keys or sorted(qs):
        if k not in sqls:
            print(f"{k:24s} (no oracle)")
            continue
        ok, n, ts, td, msg = compare(spark, con, sf_dir, k, qs[k], sqls[k])
        bad += not ok
        print(f"{k:24s} {'OK ' if ok else 'BAD'} rows={n:<8d} spark={ts:6.2f}s duck={td:6.2f}s {msg}")
    spark.stop()
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()

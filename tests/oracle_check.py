"""Run registered queries in Spark and their SQL twins in DuckDB, compare.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
Mimics the driver: row count, sorted column names, order-insensitive values.
"""

from __future__ import annotations

import datetime
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from basketlab.fixtures import TABLES  # noqa: E402
from basketlab.session import get_session  # noqa: E402


def norm(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float) and v.is_integer() and abs(v) < 2**53:
        return str(int(v))
    if isinstance(v, float):
        return repr(round(v, 6))
    if isinstance(v, (pd.Timestamp, datetime.datetime)):
        v = pd.Timestamp(v)
        return str(v.date()) if v == v.normalize() else str(v.to_pydatetime())
    if isinstance(v, datetime.date):
        return str(v)
    if isinstance(v, (bool,)) or type(v).__name__ == "bool_":
        return str(bool(v))
    if hasattr(v, "item"):
        return norm(v.item())
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    return str(v)


def digest(df: pd.DataFrame) -> tuple[int, list[str], str]:
    cols = sorted(df.columns)
    rows = sorted("|".join(norm(v) for v in r) for r in df[cols].itertuples(index=False, name=None))
    return len(rows), cols, hashlib.sha256("\n".join(rows).encode()).hexdigest()[:16]


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:]
    spark = get_session("local[8]", conf={"spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, sql = E.queries(), E.oracle_sql()
    bad = 0
    for k in keys or list(qs):
        t0 = time.time()
        try:
            sdf = qs[k](spark, sf)
            pdf = pd.DataFrame([r.asDict() for r in sdf.collect()], columns=sdf.columns)
            st = time.time() - t0
            if k not in sql:
                print(f"{k:24s} ROWS-ONLY rows={len(pdf)} spark={st:.1f}s")
                continue
            odf = con.execute(sql[k]).df()
            a, b = digest(pdf), digest(odf)
            ok = a == b
            bad += not ok
            print(f"{k:24s} {'OK ' if ok else 'BAD'} spark={a[0]} duck={b[0]} {st:.1f}s"
                  + ("" if ok else f"\n   cols {a[1]} vs {b[1]}"))
            if not ok and a[1] == b[1]:
                sa = {"|".join(norm(v) for v in r) for r in pdf[a[1]].itertuples(index=False, name=None)}
                sb = {"|".join(norm(v) for v in r) for r in odf[b[1]].itertuples(index=False, name=None)}
                print("   spark-only", sorted(sa - sb)[:4], "\n   duck-only", sorted(sb - sa)[:4])
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"{k:24s} ERROR {type(e).__name__}: {str(e)[:400]}")
    print("mismatches:", bad)


if __name__ == "__main__":
    main()

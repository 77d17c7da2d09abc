"""Run registered queries against their SQL twins in DuckDB: python tools/compare.py [sf] [name ...]."""

from __future__ import annotations

import glob
import os
import sys
import time
import traceback

import duckdb
import numpy as np
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wattloom.catalog import ORACLE, QUERIES
from wattloom.session import local_session


def normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        s = df[c]
        if s.dtype == object:
            df[c] = s.map(lambda v: None if v is None or v is pd.NA or (isinstance(v, float) and np.isnan(v)) else str(v)).astype(object)
        elif str(s.dtype).startswith(("datetime", "date")):
            df[c] = pd.to_datetime(s).astype("datetime64[us]").astype(str)
        elif s.dtype == bool or str(s.dtype) == "boolean":
            df[c] = s.map(lambda v: None if v is pd.NA else str(v)).astype(object)
        else:
            df[c] = pd.to_numeric(s).astype(float) + 0.0
    df = df.sort_values(list(df.columns), na_position="first", kind="mergesort").reset_index(drop=True)
    return df


def differences(a: pd.DataFrame, b: pd.DataFrame) -> str | None:
    if sorted(a.columns) != sorted(b.columns):
        return f"columns {sorted(a.columns)} against {sorted(b.columns)}"
    if len(a) != len(b):
        return f"rows {len(a)} against {len(b)}"
    a, b = normal(a), normal(b)
    bad = []
    for c in a.columns:
        same = (a[c] == b[c]) | (a[c].isna() & b[c].isna())
        if not same.all():
            i = int(np.argmin(same.to_numpy()))
            bad.append(f"{c}: {int((~same).sum())} rows, first {a[c].iloc[i]!r} against {b[c].iloc[i]!r}")
    return "; ".join(bad) or None


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    db = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        db.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    failed = 0
    for name in names:
        started = time.time()
        try:
            spark_result = QUERIES[name](spark, sf).toPandas()
            took = time.time() - started
            if name not in ORACLE:
                print(f"\nrows  {name:32s} {len(spark_result):7d} rows {took:6.2f}s", flush=True)
                failed += len(spark_result) == 0
                continue
            began = time.time()
            twin = db.sql(ORACLE[name]).df()
            problem = differences(spark_result, twin)
            if problem or len(spark_result) == 0:
                failed += 1
            tag = "DIFF " if problem else ("EMPTY" if len(spark_result) == 0 else "ok   ")
            print(f"\n{tag} {name:32s} {len(spark_result):7d} rows {took:6.2f}s sql {time.time() - began:5.2f}s {problem or ''}", flush=True)
        except Exception as error:
            failed += 1
            print(f"\nERROR {name}: {type(error).__name__} {str(error)[:900]}", flush=True)
            if os.environ.get("TRACE"):
                traceback.print_exc()
    print(f"{len(names) - failed} of {len(names)} good")
    return failed


if __name__ == "__main__":
    sys.exit(main())

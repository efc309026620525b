"""Run catalogued queries next to their DuckDB text and compare whole results."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _norm(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and value != value):
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        return round(float(value), 9) + 0.0
    if hasattr(value, "isoformat"):
        return value.isoformat()
    if isinstance(value, (bytes, bytearray)):
        return bytes(value)
    return str(value)


def rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    return sorted((tuple(_norm(v) for v in r) for r in frame.itertuples(index=False, name=None)), key=repr)


def difference(spark_frame: pd.DataFrame, duck_frame: pd.DataFrame) -> str | None:
    if sorted(spark_frame.columns) != sorted(duck_frame.columns):
        return f"columns {sorted(spark_frame.columns)} vs {sorted(duck_frame.columns)}"
    a, b = rows(spark_frame), rows(duck_frame)
    if len(a) != len(b):
        return f"rows {len(a)} vs {len(b)}: {str(next(iter(set(a) ^ set(b)), None))[:300]}"
    for x, y in zip(a, b):
        if x != y:
            return f"{str(x)[:300]} vs {str(y)[:300]}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry

    from tilewright.session import get_spark

    folder = sys.argv[1]
    only = sys.argv[2:]
    spark = get_spark(cores=8)
    con = connect(folder)
    oracle = entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        start = time.time()
        try:
            got = run(spark, folder).toPandas()
            took = time.time() - start
            if name in oracle:
                want = con.execute(oracle[name]).df()
                diff = difference(got, want)
            else:
                diff = None
            note = "ok" if diff is None else "DIFF " + diff
            types = "" if name not in oracle else f" duck {time.time() - start - took:.1f}s"
        except Exception as error:  # noqa: BLE001
            took, note, types = time.time() - start, f"ERROR {type(error).__name__} {str(error)[:1500]}", ""
            got = []
        bad += note != "ok"
        print(f"{name:26s} {took:6.1f}s{types} rows={len(got)} {note}", flush=True)
    print("failures:", bad)

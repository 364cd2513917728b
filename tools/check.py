"""Run registered queries on Spark and their SQL on DuckDB and compare the results.

Usage: python tools/check.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from chronogrid.plans.catalog import ORACLES, QUERIES  # noqa: E402
from chronogrid.session import local_session  # noqa: E402


def cell(value) -> str:
    """One value as comparable text; numbers keep nine significant digits."""
    if value is None or value is pd.NaT:
        return "NULL"
    if isinstance(value, float):
        return "NULL" if math.isnan(value) else repr(float(value) + 0.0)
    if isinstance(value, Decimal):
        return repr(float(value))
    return str(value)


def rows_of(names: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def kind(name: str) -> str:
    name = name.lower()
    return {"long": "bigint", "string": "varchar", "timestamp_ntz": "timestamp", "int": "integer"}.get(name, name)


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = local_session(8, "check")
    con = connect(args.sf)
    bad = 0
    for name in QUERIES:
        if args.names and not any(name.startswith(n) for n in args.names):
            continue
        begin = time.time()
        try:
            df = QUERIES[name](spark, args.sf)
            got = rows_of(df.columns, df.collect())
            took = time.time() - begin
            if name not in ORACLES:
                print(f"rows  {name}: {len(got)} rows {took:.2f}s", flush=True)
                bad += not got
                continue
            cur = con.execute(ORACLES[name])
            columns = [d[0] for d in cur.description]
            types = {d[0]: str(d[1]) for d in cur.description}
            want = rows_of(columns, cur.fetchall())
            faults = []
            if sorted(columns) != sorted(df.columns):
                faults.append(f"columns {sorted(df.columns)} != {sorted(columns)}")
            else:
                for c, t in df.dtypes:
                    if kind(t) != kind(types[c]):
                        faults.append(f"type of {c}: {t} != {types[c]}")
                if len(got) != len(want):
                    faults.append(f"{len(got)} rows != {len(want)}")
                diff = [(a, b) for a, b in zip(got, want) if a != b]
                if diff:
                    faults.append(f"{len(diff)} rows differ, first {diff[0]}")
            state = "FAIL" if faults else ("EMPTY" if not got else "ok   ")
            bad += state != "ok   "
            print(f"{state} {name}: {len(got)} rows {took:.2f}s", *faults, sep="\n      " if faults else " ", flush=True)
        except Exception as error:  # noqa: BLE001
            bad += 1
            text = str(error).split("JVM stacktrace")[0][:1500]
            print(f"ERROR {name}: {type(error).__name__} {text}", flush=True)
    print(f"{bad} not ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)

"""Compare registered queries with DuckDB on the same Parquet files.

    python tests/oracle.py [sf folder] [name part ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if value is None or value is pd.NaT:
        return None
    if isinstance(value, (float, np.floating)):
        return None if math.isnan(value) else round(float(value), 9) + 0.0
    if isinstance(value, (np.integer,)):
        return int(value)
    if isinstance(value, (np.bool_,)):
        return bool(value)
    if isinstance(value, (list, tuple, np.ndarray)):
        return tuple(_plain(v) for v in value)
    return value


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    columns = sorted(frame.columns)
    values = [[_plain(v) for v in frame[c].tolist()] for c in columns]
    return sorted(zip(*values), key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def differences(mine: pd.DataFrame, theirs: pd.DataFrame) -> str | None:
    if sorted(mine.columns) != sorted(theirs.columns):
        return f"columns {sorted(mine.columns)} / {sorted(theirs.columns)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} / {len(theirs)}"
    kinds = [(c, str(mine[c].dtype), str(theirs[c].dtype)) for c in mine.columns]
    odd = [k for k in kinds if k[1] != k[2] and not (k[1] == "object" or k[2] == "object")]
    a, b = rows_of(mine), rows_of(theirs)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} rows differ, first {str(bad[0])[:400]}"
    if odd:
        return f"types {odd}"
    return None


def check(spark, con, folder: str, name: str, query, sql: str | None) -> tuple[bool, str]:
    started = time.time()
    frame = query(spark, folder)
    mine = frame.toPandas()
    spent = time.time() - started
    if sql is None:
        return True, f"rows {len(mine)} (no SQL) {spent:.1f}s"
    started = time.time()
    theirs = con.execute(sql).df()
    message = differences(mine, theirs)
    return message is None, f"rows {len(mine)} {spent:.1f}s sql {time.time() - started:.1f}s {message or ''}"


def main() -> int:
    import __spark_entry__ as entry
    from lodestar.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sql = entry.oracle_sql()
    failed = []
    for name, query in entry.queries().items():
        if parts and not any(p in name for p in parts):
            continue
        try:
            good, message = check(spark, con, folder, name, query, sql.get(name))
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            good, message = False, f"{type(error).__name__}: {str(error)[:1500]}"
        print(("ok   " if good else "FAIL ") + name, message, flush=True)
        if not good:
            failed.append(name)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())

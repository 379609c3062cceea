"""Compare registered queries with their SQL counterparts on a folder of test tables.

As a script: ``python -m tests.oracle_check <folder> [query ...]``
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when names and values agree, else a short text."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    ours = _bag(df.columns, df.collect())
    theirs = _bag(names, result.fetchall())
    if ours == theirs:
        return None
    shown = sorted(names)
    return (
        f"{sum(ours.values())} rows against {sum(theirs.values())}; {shown}\n"
        f"  only ours:   {list((ours - theirs).items())[:3]}\n"
        f"  only theirs: {list((theirs - ours).items())[:3]}"
    )


def main(folder: str, chosen: list[str]) -> int:
    from newsloom.catalog import ORACLES, QUERIES
    from newsloom.session import build_session

    spark = build_session(
        master="local[8]",
        extra={
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in chosen or list(QUERIES):
        started = time.time()
        try:
            found = differences(QUERIES[name](spark, folder), con, ORACLES[name])
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:500]}"
        bad += found is not None
        took = time.time() - started
        print(f"{'ok ' if found is None else 'BAD'} {name} {took:.1f}s", flush=True)
        if found:
            print("  " + found[:1500], flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))

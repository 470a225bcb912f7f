"""Run registered queries and their DuckDB counterparts side by side: ``python -m checks.compare [sf_dir] [name…]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

from checks.oracles import oracle_sql
from checks.registry import queries
from loomwork.session import local_session

ROOT = "/root/testdata"


def duckdb_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def sorted_rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else f"{ROOT}/sf0.01"
    chosen = sys.argv[2:] or list(oracle_sql())
    spark = local_session(8)
    connection = duckdb_tables(sf_dir)
    failed = 0
    for name in chosen:
        start = time.time()
        df = queries()[name](spark, sf_dir)
        mine = sorted_rows(df.columns, [tuple(row) for row in df.collect()])
        took = time.time() - start
        if name not in oracle_sql():
            print(f"{name:28s} {len(mine):8d} rows  {took:6.2f}s  no SQL", flush=True)
            continue
        start = time.time()
        result = connection.execute(oracle_sql()[name])
        columns = [d[0] for d in result.description]
        theirs = sorted_rows(columns, result.fetchall())
        same = sorted(columns) == sorted(df.columns) and mine == theirs
        failed += not same
        sql_took, verdict = time.time() - start, "ok" if same else "DIFFERS"
        print(f"{name:28s} {len(mine):8d} rows  {took:6.2f}s  {sql_took:6.2f}s  {verdict}", flush=True)
        if not same:
            print(sorted(df.columns), sorted(columns), len(mine), len(theirs))
            for pair in [p for p in zip(mine, theirs) if p[0] != p[1]][:3]:
                print("  ", pair)
    return failed


if __name__ == "__main__":
    sys.exit(main())

"""Compare queries with their SQL: ``python tests/check_oracle.py [folder] [query ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as contract  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return names, result.fetchall()


def connect(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return con


def _sorted(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def compare(df: DataFrame, con, sql: str) -> str | None:
    """None when equal, otherwise what differs."""
    names, expected = oracle_rows(con, sql)
    got = [tuple(r) for r in df.collect()]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(names)}"
    if len(got) != len(expected):
        return f"{len(got)} rows instead of {len(expected)}"
    for a, b in zip(_sorted(df.columns, got), _sorted(names, expected)):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} instead of {b}"
    return None


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parent))
    from conftest import local_session

    args = sys.argv[1:]
    folder = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = local_session()
    con = connect(folder)
    oracle = contract.oracle_sql()
    for name, run in contract.queries().items():
        if args and name not in args:
            continue
        begin = time.time()
        try:
            df = run(spark, folder)
            problem = compare(df, con, oracle[name]) if name in oracle else f"{df.count()} rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:28s} {time.time() - begin:6.2f}s  {problem or 'ok'}", flush=True)


if __name__ == "__main__":
    main()

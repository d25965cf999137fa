"""Runs registered queries against their SQL on the driver tables.

python tests/compare.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "documents",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def _canonical(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ("", "")
    if isinstance(value, bool):
        return ("b", str(value))
    if isinstance(value, (int, float)):
        return ("n", repr(float(value)))
    return ("s", str(value))


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_canonical(row[i]) for i in order) for row in rows)


def difference(spark_df, connection, sql: str) -> str | None:
    """None when both give the same columns, types (broadly) and rows."""
    found = connection.execute(sql)
    names = [d[0] for d in found.description]
    expected = rows_of(names, found.fetchall())
    actual = rows_of(spark_df.columns, spark_df.collect())
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} vs {sorted(names)}"
    if len(actual) != len(expected):
        return f"{len(actual)} rows vs {len(expected)}"
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    if wrong:
        a, e = wrong[0]
        cells = [(n, x[1], y[1]) for n, x, y in zip(sorted(names), a, e) if x != y]
        return f"{len(wrong)} of {len(actual)} rows differ, first: {cells}"
    return None


def main() -> int:
    import __spark_entry__ as registered
    from bazaarlake.session import local_session

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    prefixes = tuple(args[1:])
    spark = local_session(8)
    connection = duck(sf_dir)
    sql = registered.oracle_sql()
    bad = 0
    for name, query in registered.queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in sql:
                problem = difference(df, connection, sql[name])
            else:
                problem = f"no SQL, {df.count()} rows"
        except Exception as error:
            problem = f"failed: {str(error)[:600]}"
        if problem:
            bad += 1
        print(f"{name:34s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print("problems:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)

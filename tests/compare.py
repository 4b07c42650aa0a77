"""Side-by-side run of the registered queries and their SQL.

    python tests/compare.py [folder] [query ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _text(value) -> str:
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)) or hasattr(value, "dtype"):
        number = float(value)
        return repr(number + 0.0 if number else 0.0)
    return str(pd.Timestamp(value)) if hasattr(value, "year") else str(value)


def rows_of(columns: list[str], rows) -> tuple[list[str], list[tuple[str, ...]]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_text(r[i]) for i in order) for r in rows)


def difference(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both give the same rows, else what differs."""
    got_names, got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = con.execute(sql)
    want_names, want = rows_of([d[0] for d in result.description], result.fetchall())
    if got_names != want_names:
        return f"columns: only Spark {set(got_names) - set(want_names)}, only SQL {set(want_names) - set(got_names)}"
    if len(got) != len(want):
        return f"rows: Spark {len(got)}, SQL {len(want)}"
    wrong: dict[str, int] = {}
    example = None
    for a, b in zip(got, want):
        for name, x, y in zip(got_names, a, b):
            if x != y:
                wrong[name] = wrong.get(name, 0) + 1
                example = example or (name, x, y)
    return f"values: {wrong}, e.g. {example}" if wrong else None


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from tickloom.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark, con, oracle = local_session(), connect(folder), oracle_sql()
    bad = 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            found = difference(query(spark, folder), con, oracle[name]) if name in oracle else "no SQL"
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += found is not None
        print(f"{name:28s} {time.time() - start:6.1f}s  {found or 'ok'}", flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main()

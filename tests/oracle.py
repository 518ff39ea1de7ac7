"""Compare registered queries with their SQL in DuckDB.

``python -m tests.oracle [--sf DIR] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import sys
import time
import traceback

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(lines, key=repr)


def close(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or abs(a - b) <= 1e-9 * max(1.0, abs(a), abs(b))
    return a == b and type(a) is type(b)


def compare(spark_df, con, text) -> str:
    """'' when equal, else what differs."""
    expected = con.execute(text)
    names = [d[0] for d in expected.description]
    want_cols, want = table_of(names, expected.fetchall())
    got_cols, got = table_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if want_cols != got_cols:
        return f"columns: {got_cols} instead of {want_cols}"
    if len(want) != len(got):
        return f"rows: {len(got)} instead of {len(want)}; e.g. {got[:2]} / {want[:2]}"
    for g, w in zip(got, want):
        if not all(close(a, b) for a, b in zip(g, w)):
            return f"row: {g} instead of {w} ({got_cols})"
    exact = sum(g != w for g, w in zip(got, want))
    return f"only close: {exact} rows" if exact else ""


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    args = parser.parse_args()
    import __spark_entry__ as entry
    from basketlens.session import build_session

    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    queries, oracle = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in args.names or list(queries):
        start = time.time()
        try:
            df = queries[name](spark, args.sf)
            if name in oracle:
                problem = compare(df, con, oracle[name])
                note = f"{len(df.columns)} cols"
            else:
                problem, note = "", f"rows only: {len(df.collect())}"
        except Exception as error:  # report and go on
            problem, note = f"{type(error).__name__}: {str(error)[:1500]}", ""
            if args.names:
                traceback.print_exc()
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {note} {problem}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())

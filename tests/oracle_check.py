"""Compare registered queries with their SQL in DuckDB, value by value."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from ticketlake_queries.shapes import TABLES  # noqa: E402


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        return f"decimal {value}"  # decimals must not leave a query: the engines type them differently
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str | None:
    """None if both agree, else what differs."""
    cur = con.execute(sql)
    want_cols, want = [c[0] for c in cur.description], cur.fetchall()
    got_cols, got = df.columns, df.collect()
    if sorted(want_cols) != sorted(got_cols):
        return f"columns {sorted(got_cols)} != {sorted(want_cols)}"
    a, b = bag(got_cols, got), bag(want_cols, want)
    if a == b:
        return None
    return f"rows {sum(a.values())} / {sum(b.values())}; spark only {list((a - b).items())[:3]}; sql only {list((b - a).items())[:3]}"


if __name__ == "__main__":
    import __spark_entry__ as entry
    from ticketlake.session import local_session

    sf_dir = sys.argv[1]
    only = sys.argv[2:]
    spark, con = local_session(8), connect(sf_dir)
    bad = 0
    for name, fn in entry.queries().items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            df = fn(spark, sf_dir)
            sql = entry.oracle_sql().get(name)
            problem = compare(df, con, sql) if sql else f"no SQL, {df.count()} rows"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        if problem:
            bad += 1
        print(f"{name:28s} {time.time() - t:6.2f}s {problem or 'ok'}", flush=True)
    print("problems:", bad)

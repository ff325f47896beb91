"""Runs every query beside its SQL and compares the results as multisets of rows.

    python -m harness.compare [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

from farestar.session import build_session
from harness.oracle import all_sql
from harness.registry import all_queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value):
    """One Python value for what either engine returns."""
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float, Decimal)):
        number = float(value)
        return None if math.isnan(number) else number
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return str(value)


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def expected(sf_dir: str, statement: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS FROM '{sf_dir}/{table}.parquet'")
    result = connection.execute(statement)
    return [column[0] for column in result.description], result.fetchall()


def differences(df, sf_dir: str, statement: str) -> str | None:
    names, rows = expected(sf_dir, statement)
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} are not {sorted(names)}"
    ours, theirs = rows_of(df.columns, df.collect()), rows_of(names, rows)
    if ours == theirs:
        return None
    return (
        f"{sum(ours.values())} rows against {sum(theirs.values())};"
        f" only ours {list((ours - theirs).items())[:2]}, only theirs {list((theirs - ours).items())[:2]}"
    )


def main(sf_dir: str, wanted: list[str]) -> int:
    spark = build_session("compare", "local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    statements, failed = all_sql(), 0
    for name, query in all_queries().items():
        if wanted and name not in wanted:
            continue
        begun = time.time()
        df = query(spark, sf_dir)
        problem = differences(df, sf_dir, statements[name]) if name in statements else None
        failed += problem is not None
        print(f"{name:28s} {time.time() - begun:6.2f}s  {problem or 'equal'}", flush=True)
    return failed


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    sys.exit(main(folder, sys.argv[2:]))

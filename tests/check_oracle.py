"""Compare queries with their DuckDB twins: python tests/check_oracle.py [sf_dir] [name ...]"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402

TABLES = ("supplier", "orders", "lineitem", "events", "documents", "embeddings", "benchmark", "labels", "conversations")


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, float):
        return None if math.isnan(value) else repr(float(value))
    return value


def spark_rows(df) -> tuple[list[str], Counter]:
    columns = sorted(df.columns)
    return columns, Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())


def duck_rows(con, statement: str) -> tuple[list[str], Counter]:
    cursor = con.execute(statement)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = Counter(tuple(plain(r[i]) for i in order) for r in cursor.fetchall())
    return [names[i] for i in order], rows


def compare(spark, con, sf_dir: str, name: str) -> str | None:
    """None if equal, else what differs."""
    columns, got = spark_rows(entry.queries()[name](spark, sf_dir))
    names, wanted = duck_rows(con, entry.oracle_sql()[name])
    if columns != names:
        return f"columns {columns} / {names}"
    if got != wanted:
        only_spark, only_duck = list((got - wanted).items()), list((wanted - got).items())
        return (
            f"{sum(got.values())} / {sum(wanted.values())} rows, {len(only_spark)} differ:"
            f"\n  spark {only_spark[:2]}\n  duck  {only_duck[:2]}"
        )
    return None


def main() -> int:
    from tests.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark, con = local_session(), connect(sf_dir)
    failed = 0
    for name in entry.queries():
        if chosen and not any(c in name for c in chosen):
            continue
        begin = time.time()
        try:
            if name in entry.oracle_sql():
                problem = compare(spark, con, sf_dir, name)
                note = "equal"
            else:
                problem = None
                note = f"{entry.queries()[name](spark, sf_dir).count()} rows, no twin"
        except Exception as error:
            problem, note = f"{type(error).__name__}: {str(error)[:600]}", ""
        failed += problem is not None
        print(f"{name}: {problem or note} [{time.time() - begin:.1f}s]", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())

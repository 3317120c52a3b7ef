"""Compare every registered query with its SQL: ``python tests/oracle.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if hasattr(value, "tolist"):
        value = value.tolist()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def compare(spark, con, sf_dir: str, query, sql: str) -> list[str]:
    """Differences in columns, types of values, row counts and rows; empty when equal."""
    df = query(spark, sf_dir)
    got = _bag(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = _bag(names, cursor.fetchall())
    problems = []
    if sorted(names) != sorted(df.columns):
        problems.append(f"columns {sorted(set(names) ^ set(df.columns))}")
    if sum(got.values()) != sum(expected.values()):
        problems.append(f"rows spark {sum(got.values())} sql {sum(expected.values())}")
    if got != expected:
        extra, missing = got - expected, expected - got
        problems.append(f"values: {sum(extra.values())} only in spark, e.g. {list(extra)[:2]}")
        problems.append(f"        {sum(missing.values())} only in sql, e.g. {list(missing)[:2]}")
    for a, b in zip(sorted(got, key=repr)[:50], sorted(expected, key=repr)[:50]):
        kinds = [(type(x), type(y)) for x, y in zip(a, b) if x is not None and y is not None and type(x) is not type(y)]
        if kinds:
            problems.append(f"types {kinds}")
            break
    return problems


def main() -> None:
    from acervo.session import local_session
    from acervo.workloads import all_oracles, all_queries

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    wanted = sys.argv[2:]
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    con = duck(sf_dir)
    oracles = all_oracles()
    for name, query in all_queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        if name not in oracles:
            print(f"{name}: {query(spark, sf_dir).count()} rows, no SQL")
            continue
        try:
            problems = compare(spark, con, sf_dir, query, oracles[name])
        except Exception as error:  # noqa: BLE001
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        print(f"{name}: {'ok' if not problems else 'DIFFERENT'} {time.time() - start:.1f}s")
        for p in problems:
            print("   ", p[:1500])


if __name__ == "__main__":
    main()

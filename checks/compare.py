"""Runs registered queries next to their SQL counterparts and compares the rows.

    python -m checks.compare <sf_dir> [query ...]
"""

from __future__ import annotations

import sys
import time
import traceback

import duckdb

from checks import oracles, queries
from goldweave.session import build_session

# The given tables.
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split()


def _cell(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        return round(float(value), 9)
    if hasattr(value, "as_tuple"):
        return round(float(value), 9)
    return str(value)


def _rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    key = lambda row: tuple((v is None, str(v)) for v in row)
    return sorted((tuple(_cell(row[i]) for i in order) for row in rows), key=key)


def oracle_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    result = con.execute(sql)
    return [d[0] for d in result.description], result.fetchall()


def compare(spark, sf_dir: str, name: str) -> str:
    """'' when a query and its SQL agree, else what differs."""
    df = queries.registry()[name](spark, sf_dir)
    ours = [tuple(r) for r in df.collect()]
    sql = oracles.registry().get(name)
    if sql is None:
        return "" if ours else "no rows"
    columns, theirs = oracle_rows(sf_dir, sql)
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(columns)}"
    a, b = _rows(df.columns, ours), _rows(columns, theirs)
    if a == b:
        return ""
    extra = [r for r in a if r not in set(b)][:2]
    lacking = [r for r in b if r not in set(a)][:2]
    return f"rows {len(a)} / {len(b)}; only ours {extra}; only theirs {lacking}"


def main(sf_dir: str, names: list[str]) -> int:
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g",
                          spark__ui__enabled="false", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names or list(queries.registry()):
        start = time.time()
        try:
            problem = compare(spark, sf_dir, name)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
            if "-v" in sys.argv:
                traceback.print_exc()
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok':5s} {time.time() - start:6.2f}s {name} {problem[:1500]}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], [a for a in sys.argv[2:] if not a.startswith("-")]))

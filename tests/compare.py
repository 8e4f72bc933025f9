"""Runs registered queries in Spark and their SQL in DuckDB and compares whole results."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def sort_key(row: tuple) -> list:
    return [(value is not None, str(value)) for value in row]


def difference(frame, relation) -> str | None:
    """None if names, types, rows and values agree exactly."""
    names = sorted(frame.columns)
    if names != sorted(relation.columns):
        return f"columns {names} != {sorted(relation.columns)}"
    spark_types = {name: KINDS.get(kind, kind) for name, kind in frame.dtypes}
    sql_types = dict(zip(relation.columns, map(str, relation.types)))
    if spark_types != sql_types:
        return f"types {[(n, spark_types[n], sql_types[n]) for n in names if spark_types[n] != sql_types[n]]}"
    mine = sorted((tuple(row[name] for name in names) for row in frame.collect()), key=sort_key)
    where = [relation.columns.index(name) for name in names]
    theirs = sorted((tuple(row[i] for i in where) for row in relation.fetchall()), key=sort_key)
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}"
    unequal = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if unequal:
        return f"{len(unequal)} of {len(mine)} rows differ, first:\n  {str(unequal[0][0])[:1500]}\n  {str(unequal[0][1])[:1500]}"
    return None


if __name__ == "__main__":
    from foldgauge.queries import QUERIES, SQL
    from foldgauge.session import local_session

    sf_dir = sys.argv[1]
    chosen = sys.argv[2:] or list(QUERIES)
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    for name in chosen:
        started = time.perf_counter()
        try:
            if name in SQL:
                problem = difference(QUERIES[name](spark, sf_dir), connection.sql(SQL[name]))
            else:
                problem = None if QUERIES[name](spark, sf_dir).count() else "no rows"
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok'} {name} {time.perf_counter() - started:.2f}s {problem or ''}", flush=True)
    print(f"{len(chosen) - failed} of {len(chosen)} agree")
    spark.stop()

"""Compare every registered query with its SQL on the given tables.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def compare(spark_rows: list[tuple], spark_columns: list[str], relation) -> str | None:
    """None if both hold the same rows, else what differs."""
    columns = sorted(spark_columns)
    if columns != sorted(relation.columns):
        return f"columns {columns} and {sorted(relation.columns)}"
    mine = sorted((repr([r[spark_columns.index(c)] for c in columns]) for r in spark_rows))
    names = list(relation.columns)
    theirs = sorted((repr([r[names.index(c)] for c in columns]) for r in relation.fetchall()))
    if len(mine) != len(theirs):
        return f"{len(mine)} rows and {len(theirs)} rows"
    for a, b in zip(mine, theirs):
        if a != b:
            return f"{a} and {b}"
    return None


def main(sf_dir: str, only: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries

    from chronoferry.config import build_session

    spark = build_session("oracle-check", "local[8]", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__sql__shuffle__partitions="8")
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    bad = 0
    for name, fn in queries().items():
        if only and name not in only:
            continue
        began = time.time()
        try:
            frame = fn(spark, sf_dir)
            rows = [tuple(r) for r in frame.collect()]
            took = time.time() - began
            relation = connection.sql(oracle_sql()[name])
            problem = compare(rows, frame.columns, relation)
            types = [(c, t) for c, t in frame.dtypes if t not in ("string", "bigint", "int", "double", "boolean")]
            problem = problem or (f"types {types}" if types else None)
            wide = [(c, str(t)) for c, t in zip(relation.columns, relation.types)]
            wide = [x for x in wide if x[1] not in ("VARCHAR", "BIGINT", "INTEGER", "DOUBLE", "BOOLEAN")]
            problem = problem or (f"SQL types {wide}" if wide else None)
        except Exception as failure:  # report and go on with the next query
            took, rows, problem = time.time() - began, [], str(failure)[:600]
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name:26s} {len(rows):8d} rows {took:6.2f} s {problem or ''}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    sys.exit(1 if main(sf, sys.argv[2:]) else 0)

"""Every registered query against its SQL on the small tables."""

import os
import subprocess
import sys

import pytest
from oracle_check import compare, connect
from support import SMALL

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def database():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(entry.QUERIES) == set(entry.ORACLE)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(entry.QUERIES))
def test_query_equals_sql(spark, database, name):
    frame = entry.queries()[name](spark, SMALL)
    assert {t for _, t in frame.dtypes} <= {"string", "bigint", "double", "boolean"}
    assert compare([tuple(r) for r in frame.collect()], frame.columns, database.sql(entry.oracle_sql()[name])) is None


PLAIN = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
import __spark_entry__ as entry
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
for name in ("lines_scan", "log_follow_growing", "endpoint_lines"):
    print("ROWS", name, entry.queries()[name](spark, sys.argv[2]).count())
"""


def test_python_sources_and_sinks_in_a_session_of_someone_else(database, tmp_path):
    """Workers and the processes that plan streams don't have the package on their path."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    ran = subprocess.run(
        [sys.executable, "-c", PLAIN, root, SMALL], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240
    )
    rows = dict(line.split()[1:] for line in ran.stdout.splitlines() if line.startswith("ROWS"))
    want = {name: str(len(database.sql(entry.ORACLE[name]).fetchall())) for name in ("lines_scan", "log_follow_growing", "endpoint_lines")}
    assert rows == want, ran.stderr[-2000:]

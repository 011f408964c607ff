from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
TESTS = os.path.join(ROOT, "tests")
for folder in (TESTS, ROOT):
    sys.path.insert(0, folder)
# Python workers import the package and the test transports too.
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, TESTS, os.environ.get("PYTHONPATH")]))

from support import SMALL  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from chronoferry.config import build_session

    session = build_session(
        "chronoferry-tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__maxMetadataStringLength="2000",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("work")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def events(spark):
    return spark.read.parquet(f"{SMALL}/events.parquet")


@pytest.fixture(scope="session")
def lineitem(spark):
    return spark.read.parquet(f"{SMALL}/lineitem.parquet")

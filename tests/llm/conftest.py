import random

import pytest
from llm_support import SMALL

ODD = "doc_id long, text string, lang string, source string, n_chars long, score double, `a.b` string, row string, ids string"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.read.parquet(f"{SMALL}/benchmark.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and names that clash."""
    rng = random.Random(5)
    long = " ".join(rng.choice(["alpha", "beta", "gamma", "délta", "x"]) + str(rng.randint(0, 99)) for _ in range(30_000))
    rows = [(k, t, "en", "s", 1, 0.5, "dot", "row", "ids") for k, t in enumerate(
        ["", " \n\t ", "one", "one two three", long, long + " end", "a  b\n\nc ", "▁ x", "the same text twice over", "the same text twice over"])]
    rows += [rows[4], rows[8], (None, None, None, None, None, None, None, None, None), (None, "no id", "en", "s", 1, 0.1, "", "", "")]
    return spark.createDataFrame(rows, ODD)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], ODD)

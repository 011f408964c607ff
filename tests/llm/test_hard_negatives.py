"""Hard negatives against all scores in plain integers."""

import math

import numpy as np
import pytest
from llm_support import SMALL
from pyspark.sql import functions as F

from chronoferry.llm import hard_negatives

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, anchors):
    """`rows` are different (id, label, vector)."""
    fine = [
        (i, label, [math.floor(256 * x) for x in v])
        for i, label, v in rows
        if None not in (i, label, v) and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, label, v in fine:
        if not anchors(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, other == label) for j, other, w in fine if j != i)
        for p, positive, _ in [s for s in scored if s[2]][:5]:
            inside = [(n, j) for n, j, same in scored if not same and -80 * p <= -100 * n <= -100 * p]
            out += [(i, positive, k + 1, j, -p, -n) for k, (n, j) in enumerate(inside[:5])]
    return sorted(out)


def mined(frame, anchors, **options):
    return sorted(tuple(r) for r in hard_negatives.mine(frame, anchors, **options).select(*COLUMNS).collect())


@pytest.mark.parametrize("shape", [(1, 1, 1), (17, 64, 33), (100, 64, 257), (40, 3, 40), (65, 130, 70)])
def test_strassen(shape):
    rng = np.random.default_rng(0)
    a, b = rng.integers(-(2**28), 2**28, shape[:2]), rng.integers(-(2**28), 2**28, shape[1:])
    for leaf in (1, 4, 16):
        assert np.array_equal(hard_negatives.strassen(a, b, leaf), (a.astype(object) @ b.astype(object)).astype(np.int64))


@pytest.mark.parametrize("tile", [4096, 60, 13])
def test_against_all_scores(spark, tile):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "label", "embedding").collect()]
    rng = np.random.default_rng(2)
    # A common vector under several labels, and near ones: ties of all kinds.
    rows += [(10_000 + k, k % 4, rows[0][2]) for k in range(60)]
    rows += [(20_000 + k, k % 3, (np.array(rows[7][2]) + rng.normal(size=64) * 0.01).tolist()) for k in range(40)]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    want = brute(rows, lambda i: i % 20 == 0)
    assert len(want) > 100
    assert mined(frame, F.col("vec_id") % 20 == 0, tile=tile) == want


@pytest.mark.parametrize("tile", [4096, 3])
def test_odd_rows(spark, tile):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.5]), (1, 1, [1.0, 0.5]), (2, 1, [0.9]), (3, 2, [1.0, 0.4]), (4, 2, [1.0, 0.4]), (5, 2, []),
            (6, None, [1.0, 1.0]), (7, 1, None), (8, 1, [1.0, None]), (9, 2, [nan, 1.0]), (10, 2, [1.0, inf]),
            (None, 2, [1.0, 0.5]), (20, 3, [-1.0, 0.25]), (21, 3, [1.0, 0.0]), (22, 2, [-1.0, 0.2, 7.0])]
    frame = spark.createDataFrame([(*r, 0, "x") for r in [*rows, rows[0], rows[3]]],
                                  "vec_id long, label int, embedding array<double>, mark int, Score string")
    want = brute(rows, lambda i: i % 10 == 0)
    assert want and mined(frame, F.col("vec_id") % 10 == 0, tile=tile) == want
    assert mined(frame.limit(0), F.col("vec_id") % 10 == 0) == []
    assert mined(frame, F.lit(None).cast("boolean")) == []


def test_text_labels_and_one_id_twice(spark):
    rows = [(0, "a", [1.0]), (0, "b", [1.0]), (1, "a", [1.0]), (1, "a", [0.9]), (2, "b", [0.9]), (3, "c", [0.95])]
    frame = spark.createDataFrame(rows, "vec_id long, label string, embedding array<float>")
    assert mined(frame, F.col("vec_id") == 0, tile=2) == brute(rows, lambda i: i == 0)


def test_scores_beyond_64_bits(spark):
    frame = spark.createDataFrame([(0, 1, [1e9, 1e9]), (1, 1, [1e9, 1e9])], "vec_id long, label int, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        hard_negatives.mine(frame, F.col("vec_id") == 0).collect()

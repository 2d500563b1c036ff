"""Exact top-k search against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendgroups.llm import topk
from spendgroups.llm.topk import segment_statistics, top_products

FIELDS = "vec_id long, embedding array<float>, label int"


def brute(rows, every, nearest):
    rows = {
        (i, tuple(math.floor(256 * float(np.float32(c))) for c in v))
        for i, v, *_ in rows
        if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)
    }
    out = []
    for i, q in rows:
        if i % every:
            continue
        near = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in rows if j != i)
        out += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(near[:nearest])]
    return sorted(out)


def found(spark, rows, every=5, nearest=5, **more):
    table = spark.createDataFrame(rows, FIELDS)
    result = top_products(table, F.col("vec_id") % every == 0, nearest, **more)
    assert result.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in result.collect())


@pytest.mark.parametrize("kind", ["random", "smooth", "equal", "uneven"])
@pytest.mark.parametrize("d", [1, 7, 64])
def test_equals_brute_force(spark, kind, d):
    rng = np.random.default_rng(d)
    n = 300
    x = {
        "random": rng.normal(size=(n, d)),
        "smooth": rng.normal(size=(n, 1)) + rng.normal(size=(n, d)).cumsum(axis=1) / 9,
        "equal": np.repeat(rng.normal(size=(3, d)), n // 3, axis=0),
        "uneven": rng.normal(size=(n, d)) * rng.lognormal(0, 2, size=(n, 1)),
    }[kind].astype(np.float32)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    assert found(spark, rows, block=40) == brute(rows, 5, 5)


def test_unusual_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (5, [0.0, 0.0], 1), (5, [-1.0, 3.0], 1),
        (1, None, 1), (2, [None, 1.0], 1), (3, [nan, 1.0], 1), (4, [inf, 1.0], 1),
        (None, [9.0, 9.0], 1), (6, [1.0, 2.0], 1), (7, [1.0, 2.0], 1), (8, [-3.0, 0.5], 1),
    ]
    assert found(spark, rows) == brute(rows, 5, 5)
    assert found(spark, rows, nearest=1) == brute(rows, 5, 1)
    assert found(spark, rows[:2]) == []
    assert found(spark, [r for r in rows if r[0] in (1, 2)]) == []
    assert found(spark, [(0, [], 1), (1, [], 1), (5, [], 1)]) == [(0, 1, 1, 0), (0, 2, 5, 0), (5, 1, 0, 0), (5, 2, 1, 0)]
    # A row with another number of components than most takes no part.
    assert found(spark, rows + [(9, [1.0], 1)]) == brute(rows, 5, 5)


def test_large_components(spark):
    rows = [(i, [1e15 * i, -1e12 * i, 3.0], 0) for i in range(8)]
    assert found(spark, rows, nearest=3, scale=1) == sorted(
        (q, rank + 1, j, min(s, (1 << 63) - 1))
        for q in (0, 5)
        for rank, (s, j) in enumerate(
            sorted(
                (
                    (-min(sum(int(np.float32(a)) * int(np.float32(b)) for a, b in zip(rows[q][1], rows[j][1])), (1 << 63) - 1), j)
                    for j in range(8)
                    if j != q
                )
            )[:3]
        )
        for s in [-s]
    )


def test_bounds_hold():
    rng = np.random.default_rng(1)
    a, b = rng.integers(-300, 300, (50, 64)), rng.integers(-300, 300, (40, 64))
    exact, last = a @ b.T, np.inf
    for segments in (1, 2, 4, 8, 16, 32):
        bound = segment_statistics(a, segments) @ segment_statistics(b, segments).T
        assert (bound >= exact - 1e-6).all()
        assert (bound <= last + 1e-6).all()
        last = bound
    assert (topk.scores(a, b) == exact).all()

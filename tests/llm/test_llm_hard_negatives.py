"""Strassen's recursion and mined negatives against direct products."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripfunnel.llm import hard_negatives


@pytest.mark.parametrize("shape", [(1, 1, 1), (33, 64, 35), (70, 64, 129), (100, 37, 41), (0, 4, 9), (64, 128, 64), (5, 0, 6)])
def test_product_is_exact(shape):
    n, k, m = shape
    pick = np.random.default_rng(sum(shape))
    for most in (3, 1 << 20, 1 << 28):
        a, b = pick.integers(-most, most, (n, k)), pick.integers(-most, most, (k, m))
        assert (hard_negatives.strassen(a, b) == a @ b).all()
    assert hard_negatives.strassen(np.full((40, 64), 1 << 27), np.full((64, 40), 1 << 27))[0, 0] == 1 << 60


def direct(rows, anchor_every=10, low=80):
    part = []
    for n, (i, v, label) in enumerate(rows):
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            part.append((n, i, [math.floor(256 * x) for x in v], label))
    order = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = []
    for n, i, v, label in part:
        if i is None or i % anchor_every:
            continue
        score = lambda w: sum(a * b for a, b in zip(v, w))
        same = sorted([(score(w), j) for m, j, w, other in part if m != n and other == label], key=order)
        others = sorted([(score(w), j) for m, j, w, other in part if other != label], key=order)
        for p, positive in same[:5]:
            inside = [(s, j) for s, j in others if low * p <= 100 * s <= 100 * p][:5]
            out += [(i, positive, rank, j, p, s) for rank, (s, j) in enumerate(inside, 1)]
    return sorted(out, key=str)


def table(pick, n=260):
    rows = []
    for i in range(n):
        size = 8 if i % 11 else int(pick.integers(1, 8))
        rows.append((i - 20, pick.normal(size=size).round(1).tolist(), 0 if i % 3 == 0 else int(pick.integers(1, 4))))
    rows += [(400 + i, rows[40][1], i % 4) for i in range(60)]  # many equal vectors: ties
    rows += [(0, rows[31][1], 2), rows[50], (None, rows[60][1], 1), (None, rows[0][1], None)]
    rows += [(600, None, 1), (610, [], 1), (620, [None, 1.0], 1), (630, [float("nan")], 1), (640, [float("inf")], 2), (650, [0.0] * 8, None)]
    return rows


@pytest.mark.parametrize("blocks", [{}, {"anchor_rows": 9, "chunk_rows": 70}])
def test_negatives_equal_brute_force(spark, blocks, monkeypatch):
    if blocks:
        monkeypatch.setattr(hard_negatives, "TILE", (8, 16))
    rows = table(np.random.default_rng(3))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    frame = frame.select("*", *[F.lit(9).alias(c) for c in ("row", "id", "v", "block", "chunk", "score", "nth", "anchor")])
    found = hard_negatives.mine(frame, anchor_every=10, **blocks).collect()
    assert sorted((tuple(r) for r in found), key=str) == direct(rows)
    assert len(found) > 300


def test_odd_tables(spark):
    schema = "vec_id long, embedding array<float>, label int"
    none = spark.createDataFrame([], schema)
    assert hard_negatives.mine(none).count() == 0
    alone = spark.createDataFrame([(0, [1.0], 1), (1, [2.0], 2)], schema)  # no positive
    assert hard_negatives.mine(alone).count() == 0
    below = spark.createDataFrame([(0, [1.0], 1), (1, [-2.0], 1), (2, [-3.0], 2)], schema)  # a window below zero is empty
    assert hard_negatives.mine(below).count() == 0
    huge = spark.createDataFrame([(0, [3e38], 1), (1, [3e38], 1), (2, [3e38], 2)], schema)
    assert [r["negative_id"] for r in hard_negatives.mine(huge).collect()] == [2]

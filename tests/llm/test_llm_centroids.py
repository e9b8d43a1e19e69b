"""Threshold algorithm and integer rounds against brute force."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripfunnel.llm import centroids


@pytest.mark.parametrize("shape", [(300, 16, 64), (200, 40, 3), (50, 1, 5), (60, 7, 1)])
def test_nearest_equals_brute_force(shape):
    n, k, dims = shape
    pick = np.random.default_rng(n)
    middle = pick.integers(-6, 6, (k, dims))
    middle[k // 2 :] = middle[: k - k // 2]  # equal centroids: the first one wins
    rows = pick.integers(-8, 8, (n, dims))
    distance = ((rows[:, None] - middle[None]) ** 2).sum(axis=2)
    best, apart = centroids.Lists(middle).nearest(rows)
    assert (best == distance.argmin(axis=1)).all() and (apart == distance.min(axis=1)).all()


def test_the_walk_ends_early():
    pick = np.random.default_rng(1)
    middle = pick.integers(-1000, 1000, (500, 3))
    lists = centroids.Lists(middle)
    rows = middle + pick.integers(-2, 3, middle.shape)
    best, apart = lists.nearest(rows)
    distance = ((rows[:, None] - middle[None]) ** 2).sum(axis=2)
    assert (apart == distance.min(axis=1)).all() and (best == distance.argmin(axis=1)).all()
    assert lists.exact < 0.1 * distance.size


def test_extreme_components_stay_exact():
    most = centroids.most_component(64)
    middle = np.array([[most] * 64, [-most] * 64, [0] * 64])
    best, apart = centroids.Lists(middle).nearest(np.array([[-most] * 64, [most] * 64, [1] * 64]))
    assert best.tolist() == [1, 0, 2] and apart.tolist() == [0, 0, 64]
    assert 64 * (2 * most) ** 2 < 2**63


def direct(rows, k, rounds, scale=64):
    kept = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows]
    kept.sort(key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    middle = [v for _, v in kept[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(middle)) for _, v in kept]

    for _ in range(rounds):
        where = assign()
        for c in range(len(middle)):
            inside = [v for (_, v), (_, w) in zip(kept, where) if w == c]
            if inside:
                middle[c] = [sum(x) // len(inside) for x in zip(*inside)]
    return [(i, c, d) for (i, _), (d, c) in zip(kept, assign())], middle


def test_clusters_equal_brute_force(spark):
    pick = np.random.default_rng(4)
    rows = [(i, pick.normal(size=6).astype(np.float32).astype(float).tolist()) for i in range(120)]
    rows += [(7, rows[7][1]), (7, rows[8][1]), (None, rows[9][1])]  # a repeated row and id, and no id
    rows += [(300 + i, rows[0][1]) for i in range(60)]  # a third of all rows alike
    bad = [(500, None), (501, []), (502, [1.0] * 5), (503, [None] + [1.0] * 5), (504, [float("nan")] * 6), (505, [float("inf")] * 6)]
    frame = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").repartition(5)
    frame = frame.select("*", F.lit(1).alias("cluster"), F.lit(2).alias("v"), F.lit(3).alias("id"), F.lit(4).alias("distance"))
    found, middle = centroids.cluster(frame, dims=6, k=9)
    expected, direct_middle = direct(rows, 9, 3)
    order = lambda rows: sorted(rows, key=str)
    assert middle.tolist() == direct_middle
    assert order(tuple(r) for r in found.collect()) == order(expected)
    told = centroids.report(found, middle).collect()
    assert {r["inertia"] for r in told} == {sum(d for *_, d in expected)}
    for r in told:
        assert r["cluster_inertia"] == sum(d for _, c, d in expected if c == r["cluster"])
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, direct_middle[r["cluster"]])).encode()).hexdigest()


def test_few_none_and_far_vectors(spark):
    schema = "vec_id long, embedding array<double>, label int"
    none = spark.createDataFrame([], schema)
    assert centroids.report(*centroids.cluster(none)).count() == 0
    far = spark.createDataFrame([(1, [1e300] * 64, 1), (2, [-1e300] * 64, 1), (3, [0.0] * 64, None)], schema)
    told = centroids.report(*centroids.cluster(far)).collect()
    assert sorted((r["vec_id"], r["distance"]) for r in told) == [(1, 0), (2, 0), (3, 0)]
    assert len({r["cluster"] for r in told}) == 3

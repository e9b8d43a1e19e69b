"""Connected components of a link table, by alternating star steps on DataFrames."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripfunnel.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the least node around it."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the least of them (edges run from u down to v)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (least node reachable) of every node in a link, for columns ``a`` and ``b``.

    The links are undirected; repeats and links of a node with itself do no harm. Rounds end when
    the table stays as it is, after about log(longest path) of them. A hub costs one row per task in
    the minima, and its join partition can be split. Every round is a stored table.
    """
    edges = stored(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    before = None
    while True:
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v").cast("double"))).first()
        if now[0] == 0 or now == before:
            break
        before = now
        edges = stored(_small_star(_large_star(edges)), "stars")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0 to n-1 of one task's links: the least node reachable."""
    root = np.arange(n)
    while len(a):
        # Only roots are hooked, so nodes of one tree stay together; paths have length one in between.
        low = np.minimum(root[a], root[b])
        hooks = root[a], root[b]
        for end in hooks:
            np.minimum.at(root, end, low)
        while True:
            jumped = root[root]
            if np.array_equal(jumped, root):
                break
            root = jumped
        differs = root[a] != root[b]
        a, b = a[differs], b[differs]
    return root

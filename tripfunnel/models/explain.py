"""Shapley values of tree ensembles, from the cover of the nodes.

A leaf pays its value when all conditions on its path hold; a condition on a feature
left out holds with the share of training rows that went that way. A path has few
features, and a row either meets a feature's conditions or not, so the Shapley values of
a leaf are a small table indexed by the pattern of met features. A batch of rows is then
only compared and looked up.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product
from math import factorial

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


@dataclass
class Leaf:
    """Per feature on the path: index, open interval (low, high], and the value table."""

    features: list[int]
    low: list[float]
    high: list[float]
    table: np.ndarray


@dataclass
class Trees:
    leaves: list[Leaf]
    base: float


def _shapley_table(shares: list[float], value: float) -> np.ndarray:
    """Row per met/unmet pattern (first feature = lowest bit), column per feature."""
    k = len(shares)
    table = np.zeros((2**k, k))
    weights = [factorial(s) * factorial(k - s - 1) / factorial(k) for s in range(k)]
    for bits in product((0, 1), repeat=k):
        row = sum(bit << i for i, bit in enumerate(bits))
        for i in range(k):
            # Coefficient s: joint payment of coalitions of s other features.
            joint = np.array([1.0])
            for j in range(k):
                if j != i:
                    joint = np.convolve(joint, [shares[j], bits[j]])
            table[row, i] = value * (bits[i] - shares[i]) * np.dot(weights, joint)
    return table


def _leaves(nodes: dict, weight: float) -> tuple[list[Leaf], float]:
    found, base = [], 0.0
    total = nodes[0]["cover"]
    stack = [(0, {})]
    while stack:
        at, path = stack.pop()
        node = nodes[at]
        if node["left"] < 0:
            value = weight * node["prediction"]
            base += value * node["cover"] / total
            if path:
                features = sorted(path)
                found.append(
                    Leaf(
                        features,
                        [path[f][0] for f in features],
                        [path[f][1] for f in features],
                        _shapley_table([path[f][2] for f in features], value),
                    )
                )
            continue
        f, cut = node["feature"], node["threshold"]
        low, high, share = path.get(f, (-np.inf, np.inf, 1.0))
        for child, bounds in (
            (node["left"], (low, min(high, cut))),
            (node["right"], (max(low, cut), high)),
        ):
            stack.append(
                (child, {**path, f: (*bounds, share * nodes[child]["cover"] / node["cover"])})
            )
    return found, base


def read_trees(spark: SparkSession, path: str, tree_weights: list[float]) -> Trees:
    """Reads a saved ensemble with numeric splits; its size is fixed by the training
    parameters (trees × 2^depth nodes), not by the data.
    """
    nodes = (
        spark.read.parquet(f"{path}/data")
        .select(
            "treeID",
            F.col("nodeData.id").alias("id"),
            F.col("nodeData.prediction").alias("prediction"),
            F.col("nodeData.rawCount").alias("cover"),
            F.col("nodeData.leftChild").alias("left"),
            F.col("nodeData.rightChild").alias("right"),
            F.col("nodeData.split.featureIndex").alias("feature"),
            F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        )
        .collect()
    )
    trees: dict[int, dict] = {}
    for node in nodes:
        trees.setdefault(node["treeID"], {})[node["id"]] = node.asDict()
    leaves, base = [], 0.0
    for tree_id, tree in trees.items():
        some, offset = _leaves(tree, tree_weights[tree_id])
        leaves += some
        base += offset
    return Trees(leaves, base)


def tree_attributions(trees: Trees, n_features: int):
    """A function from a row matrix to the matrix of per-feature impacts."""
    parts = [(x.features, x.low, x.high, x.table) for x in trees.leaves]

    def attribute(rows):
        import numpy as np

        impact = np.zeros((len(rows), n_features))
        for features, low, high, table in parts:
            values = rows[:, features]
            met = (values > low) & (values <= high)
            pattern = met @ (1 << np.arange(len(features)))
            impact[:, features] += table[pattern]
        return impact

    return attribute

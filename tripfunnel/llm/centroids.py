"""Centroid clustering of integer vectors with exact rounds; nearest centroids by the threshold algorithm.

Components become integers, so that every distance, sum and centroid is exact and the result does not
depend on how Spark has cut the table. Each round sends the centroids (``k`` vectors) to the tasks and
gets back one count and one sum per centroid and component.

A vector finds its centroid from one sorted list of centroid values per dimension. All lists are walked
outward from the vector's own value, nearest entry first; a centroid met for the first time gets its
exact distance. The squared gaps at the ends of the walks add up to a bound: no centroid that has not
been met is nearer. The walk ends when that sum is strictly greater than the best exact distance, so that
a tie can still be won by a smaller number.

Defined cases: only vectors of exactly ``dims`` components, none null, NaN or infinite, take part; others
have no row. Each row stands for itself, also one that repeats an id or another row; rows whose ids hash
alike start in the order of their components; a null id hashes as an empty one. With fewer than ``k``
vectors there are as many centroids as vectors, and an empty table gives an empty result. Components
beyond ``most_component(dims)`` saturate there, where squared distances still fit 64 bits; an inertia that
does not fit is null. Other columns of the table are not looked at.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripfunnel.llm.common import finite_vector, stored
from tripfunnel.llm.vector_dedup import matrix

#: Farther than any gap between two components.
BEYOND = 1 << 40


def most_component(dims: int) -> int:
    """The largest magnitude at which a squared distance cannot leave 64 bits."""
    return math.isqrt((2**63 - 1) // (4 * max(1, dims)))


def integers(vector: Column, scale: int, most: int) -> Column:
    """``floor(scale * x)`` of every component in double precision, saturated at ``most``."""
    value = lambda x: F.floor(F.least(F.greatest(scale * x.cast("double"), F.lit(-float(most))), F.lit(float(most))))
    return F.transform(vector, lambda x: value(x).cast("long"))


class Lists:
    """The sorted lists of centroid values, one per dimension, and the walk along them."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.order = np.argsort(centroids, axis=0, kind="stable")
        ends = np.full((1, centroids.shape[1]), BEYOND)
        self.values = np.concatenate([-ends, np.take_along_axis(centroids, self.order, axis=0), ends])
        self.exact = 0  # distances computed so far

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of every row the nearest centroid (of equally near ones the first) and its squared distance."""
        (k, dims), n = self.centroids.shape, len(rows)
        at = np.arange(dims)
        right = np.empty((n, dims), dtype=np.int64)
        for d in range(dims):
            right[:, d] = np.searchsorted(self.values[1:-1, d], rows[:, d]) + 1
        left = right - 1
        distance = np.full((n, k), np.iinfo(np.int64).max)
        active = np.arange(n)
        for _ in range(k):  # each step takes one entry from every list
            own, lo, hi = rows[active], left[active], right[active]
            below, above = own - self.values[lo, at], self.values[hi, at] - own
            down = below <= above
            gap = np.where(down, below, above)
            met = np.zeros((len(active), k), dtype=bool)
            met[np.arange(len(active))[:, None], self.order[np.where(down, lo, hi) - 1, at]] = True
            left[active], right[active] = lo - down, hi + ~down
            row, centroid = np.nonzero(met & (distance[active] == np.iinfo(np.int64).max))
            for start in range(0, len(row), 8192):
                r, c = row[start : start + 8192], centroid[start : start + 8192]
                apart = own[r] - self.centroids[c]
                distance[active[r], c] = np.einsum("ij,ij->i", apart, apart)
            self.exact += len(row)
            frontier = np.einsum("ij,ij->i", gap, gap)
            active = active[frontier <= distance[active].min(axis=1)]
            if not len(active):
                break
        best = distance.argmin(axis=1)
        return best, distance[np.arange(n), best]


def _assigned(centroids: np.ndarray):
    def run(batches):
        lists = Lists(centroids)
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                rows = matrix(part.column(part.schema.get_field_index("v")))
                yield (part, rows, *lists.nearest(rows))

    return run


def _sums(centroids: np.ndarray):
    """Per task and centroid: how many vectors it has and the sum of each component."""
    k, dims = centroids.shape

    def run(batches):
        total, n = np.zeros((k, dims), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for _, rows, cluster, _ in _assigned(centroids)(batches):
            np.add.at(total, cluster, rows)
            n += np.bincount(cluster, minlength=k)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(n[some]), pa.array(total[some].tolist(), pa.list_(pa.int64()))],
            names=["cluster", "n", "total"],
        )

    return run


def _labelled(centroids: np.ndarray):
    def run(batches):
        for part, _, cluster, distance in _assigned(centroids)(batches):
            yield pa.RecordBatch.from_arrays(
                [part.column(part.schema.get_field_index("id")), pa.array(cluster, pa.int32()), pa.array(distance)],
                names=["id", "cluster", "distance"],
            )

    return run


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: componentwise ``floor(sum / count)``; empty ones stay."""
    partial = vectors.select("v").mapInArrow(_sums(centroids), "cluster int, n long, total array<long>")
    whole = partial.select("cluster", "n", F.posexplode("total")).groupBy("cluster", "pos").agg(
        F.sum("n").alias("n"), F.sum(F.col("col").cast("decimal(38,0)")).alias("total")
    )
    after = centroids.copy()
    for r in whole.collect():  # one row per centroid and component
        after[r["cluster"], r["pos"]] = int(r["total"]) // r["n"]
    return after


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster(
    vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", dims: int = 64, scale: int = 64, k: int = 16,
    rounds: int = 3, seed: str = "1",
) -> tuple[DataFrame, np.ndarray]:
    """One row per vector (id, ``cluster``, squared ``distance``), stored, and the final centroids."""
    kept = vectors.filter((F.size(vector) == dims) & finite_vector(F.col(vector)))
    kept = stored(
        kept.select(F.col(id_column).alias("id"), integers(F.col(vector), scale, most_component(dims)).alias("v")), "vectors"
    )
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = kept.select("v", drawn.alias("drawn")).orderBy("drawn", "v").limit(k).collect()
    centroids = np.array([r["v"] for r in first], dtype=np.int64).reshape(-1, dims)
    schema = T.StructType([kept.schema["id"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    if not first:
        found = kept.select("id", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("long").alias("distance"))
    else:
        for _ in range(rounds):
            centroids = moved(kept, centroids)
        found = stored(kept.mapInArrow(_labelled(centroids), schema), "clusters")
    return found.withColumnRenamed("id", id_column), centroids


def report(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The rows of ``cluster`` with the inertia of their cluster and of all, and the digest of their centroid."""
    whole = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()
    inertia = {r["cluster"]: int(r["inertia"]) for r in whole}  # one row per centroid
    fits = lambda n: n if n < 2**63 else None
    about = [(c, fits(inertia.get(c, 0)), fits(sum(inertia.values())), digest(v)) for c, v in enumerate(centroids)]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    return found.join(F.broadcast(found.sparkSession.createDataFrame(about, schema)), "cluster").select(
        *found.columns, "cluster_inertia", "inertia", "centroid_sha256"
    )

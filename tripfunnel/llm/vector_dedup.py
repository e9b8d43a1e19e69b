"""Near-duplicate vectors: spherical k-means cells, blocked cosine products, one vector kept per group.

Vectors are compared only within their label, and link at a cosine of ``least`` or more. Spherical
k-means (fitted on at most ``sample`` vectors) gives centroids; every vector has a home cell, that of
the nearest centroid. A link may cross the border of two cells: if y lives in cell c and x in cell h,
the hyperplane between the centroids parts them, so x is no farther from that plane than
``sqrt(1 - least ** 2)``. Each vector therefore also visits all cells whose border is that near, and no
link is lost. Where vectors spread evenly in many dimensions most borders are near; the cells then save
little, which is the price of losing nothing.

Equal vectors are one point with a count. In each cell, blocks of up to ``block`` home points meet
chunks of up to ``chunk`` visitors as one matrix product, so no task holds a cell, however many points
it has. A group returns for each point the number of links and one row that ties it into the group's
forest, never its pairs.

Defined cases: vectors that are null, empty or zero, hold null or non-finite components, or have no
label link with nothing and stand for themselves; so do vectors of different lengths to each other.
Every row counts as a vector, also one that repeats an id; a null id never names a group unless it has
no other. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripfunnel.llm.common import sample_by_hash, stored
from tripfunnel.llm.components import components, local_roots


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision; scaled first, so that no square overflows."""
    rows = rows.astype(np.float64)
    rows = rows / np.maximum(np.abs(rows).max(axis=1, keepdims=True), 1e-300)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column of equally long vectors as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def spherical_kmeans(rows: np.ndarray, cells: int, rounds: int = 8) -> np.ndarray:
    """Unit centroids; a cell that empties takes the row that is farthest from its centroid."""
    cells = max(1, min(cells, len(rows)))
    chosen = np.random.default_rng(5).choice(len(rows), cells, replace=False)
    centroids = rows[np.sort(chosen)]
    for _ in range(rounds):
        near = rows @ centroids.T
        home = near.argmax(axis=1)
        worst = near.max(axis=1)
        for c in range(cells):
            inside = rows[home == c]
            total = inside.sum(axis=0) if len(inside) else rows[worst.argmin()]
            if not len(inside):
                worst[worst.argmin()] = np.inf
            length = np.linalg.norm(total)
            if length > 1e-9:
                centroids[c] = total / length
    return centroids


def visited(rows: np.ndarray, centroids: np.ndarray, least: float) -> list[np.ndarray]:
    """Of every row its home cell, then the cells whose border is near enough for a link."""
    near = rows @ centroids.T
    home = near.argmax(axis=1)
    apart = np.linalg.norm(centroids[:, None] - centroids[None], axis=2)
    behind = near[np.arange(len(rows)), home][:, None] - near
    reach = np.sqrt(max(0.0, 1 - least * least)) * apart[home] + 1e-9
    enters = behind <= reach
    enters[np.arange(len(rows)), home] = False
    return [np.concatenate([[h], np.flatnonzero(e)]) for h, e in zip(home, enters)]


def _assign(centroids: np.ndarray, least: float):
    def run(batches):
        for batch in batches:
            vectors = batch.column(batch.schema.get_field_index("v"))
            sizes = np.array([len(v) for v in vectors])
            cells: list = [[0]] * len(sizes)
            fits = np.flatnonzero(sizes == centroids.shape[1])
            for start in range(0, len(fits), 4096):
                at = fits[start : start + 4096]
                rows = unit(matrix(vectors.take(pa.array(at))))
                for i, c in zip(at, visited(rows, centroids, least)):
                    cells[i] = c
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cells, type=pa.list_(pa.int32()))], names=[*batch.schema.names, "cells"]
            )

    return run


def _compare(least: float):
    def run(table: pa.Table) -> pa.Table:
        point = table.column("point").to_numpy()
        weight = table.column("n").to_numpy()
        target = table.column("target").to_numpy(zero_copy_only=False)
        rows = unit(matrix(table.column("v")))
        targets, visitors = np.flatnonzero(target), np.flatnonzero(~target)
        local, number = np.unique(point, return_inverse=True)  # a point may be here as both
        links = np.zeros(len(visitors), dtype=np.int64)
        root = np.arange(len(local))
        for start in range(0, len(visitors), 1024):
            at = visitors[start : start + 1024]
            linked = rows[at] @ rows[targets].T >= least
            linked &= point[at][:, None] != point[targets][None]
            links[start : start + 1024] = linked @ weight[targets]
            a, b = np.nonzero(linked)
            if len(a):
                a, b = number[at[a]], number[targets[b]]
                joined = local_roots(len(local), np.concatenate([a, np.arange(len(local))]), np.concatenate([b, root]))
                root = joined
        total = np.bincount(number[visitors], weights=links, minlength=len(local)).astype(np.int64)
        tied = (root != np.arange(len(local))) | (total > 0)
        return pa.table({"point": local[tied], "links": total[tied], "root": local[root[tied]]})

    return run


def distinct_points(vectors: DataFrame, id_column: str, vector: str, label: str) -> tuple[DataFrame, DataFrame]:
    """All rows (``id`` and the pair of hashes that names the point, null if invalid), and the points.

    Rows of equal label and vector share a point. The name is 128 bits of hash, so that the vectors
    themselves are neither sorted nor compared.
    """
    v = F.col(vector)
    sound = (
        F.col(label).isNotNull() & v.isNotNull() & (F.size(v) > 0)
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(v, lambda x: x != 0)
    )
    sound = F.coalesce(sound, F.lit(False))
    rows = vectors.select(
        F.col(id_column).alias("id"), F.when(sound, v).alias("v"), F.col(label).alias("label"),
        F.when(sound, F.xxhash64(F.col(label), v)).alias("h1"),
        F.when(sound, F.xxhash64(F.lit("second"), v, F.col(label))).alias("h2"),
    )
    points = (
        rows.filter("h1 IS NOT NULL").groupBy("h1", "h2")
        .agg(F.count("*").alias("n"), F.min("id").alias("least"), F.first("v").alias("v"), F.first("label").alias("label"))
        .withColumn("point", F.monotonically_increasing_id())
    )
    return rows.select("id", "h1", "h2"), points


def near_duplicates(
    vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label", least: float = 0.98,
    sample: int = 20000, cell_points: int = 4096, most_cells: int = 256, block: int = 1024, chunk: int = 4096,
) -> DataFrame:
    """One row per vector: id, ``n_links``, ``component_id`` (least id reachable) and ``kept``."""
    rows, points = distinct_points(vectors, id_column, vector, label)
    points = stored(points, "points")
    taught = sample_by_hash(points.select("point", "v"), "point", sample).toArrow()
    placed = points.withColumn("cells", F.array(F.lit(0)))  # all there is to say of an empty table
    if taught.num_rows:
        sizes = np.array([len(v) for v in taught.column("v")])
        common = np.bincount(sizes).argmax()
        taught = taught.take(pa.array(np.flatnonzero(sizes == common)))
        cells = int(np.clip(np.ceil(points.count() / cell_points), 1, most_cells))
        centroids = spherical_kmeans(unit(matrix(taught.column("v"))), cells)
        schema = placed.schema
        placed = stored(points.mapInArrow(_assign(centroids, least), schema), "placed")
    length = F.size("v").alias("length")
    key = ["label", "length", "cell"]
    visits = placed.select("point", "n", "label", length, "v", F.posexplode("cells").alias("place", "cell"))
    sizes = visits.groupBy(key).agg(F.count("*").alias("visitors"), F.count(F.when(F.col("place") == 0, 1)).alias("homes"))
    sizes = stored(
        sizes.filter("homes > 0").select(
            *key, F.ceil(F.col("homes") / block).alias("blocks"), F.ceil(F.col("visitors") / chunk).alias("chunks")
        ),
        "cells",
    )
    met = visits.join(sizes, key)
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    pick = lambda n, salt: F.pmod(F.xxhash64("point", F.lit(salt)), F.col(n))
    visitors = met.select(*key, upto("blocks").alias("block"), pick("chunks", 1).alias("chunk"), F.lit(False).alias("target"), "point", "n", "v")
    targets = met.filter("place = 0").select(
        *key, pick("blocks", 2).alias("block"), upto("chunks").alias("chunk"), F.lit(True).alias("target"), "point", "n", "v"
    )
    ties = stored(
        visitors.unionByName(targets).groupBy(*key, "block", "chunk").applyInArrow(_compare(least), "point long, links long, root long"),
        "ties",
    )
    links = ties.groupBy("point").agg(F.sum("links").alias("links"))
    joined = stored(components(ties.select(F.col("point").alias("a"), F.col("root").alias("b"))), "components")
    rooted = (
        placed.select("point", "n", "least", "h1", "h2")
        .join(links, "point", "left")
        .join(joined, F.col("point") == F.col("node"), "left")
        .withColumn("component", F.coalesce("component", "point"))
    )
    names = rooted.groupBy("component").agg(F.min("least").alias("component_id"))
    known = rooted.join(names, "component").select(
        "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"
    )
    valid = rows.filter("h1 IS NOT NULL").join(known, ["h1", "h2"]).select("id", "n_links", "component_id")
    alone = rows.filter("h1 IS NULL").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return valid.unionByName(alone).select(
        F.col("id").alias(id_column), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def keep_one(vectors: DataFrame, id_column: str = "vec_id", **options) -> DataFrame:
    """The rows of ``vectors`` whose id names its group."""
    kept = near_duplicates(vectors, id_column, **options).filter("kept").select(F.col(id_column).alias("__id")).distinct()
    return vectors.join(kept, F.col(id_column).eqNullSafe(F.col("__id")), "left_semi")

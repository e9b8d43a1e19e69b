"""Hard-negative mining: exact inner products by Strassen's recursion, then mergeable heaps.

Vectors become integer vectors, so all scores are exact. Anchors (every row whose id is a multiple of
``anchor_every``) lie in blocks, all rows in chunks; a task gets one block and one chunk and multiplies
them tile by tile: seven products of half the size instead of eight, on int64 tiles padded with zeros.

Two passes. The first multiplies anchors with rows of their own label and keeps, per anchor, the
``positives`` best: a heap per task, merged by a rank limit. The second multiplies with all rows and
keeps, per anchor and positive, the ``negatives`` best rows of another label inside that positive's window
``low * positive <= 100 * negative <= 100 * positive``: again a heap per task, then merged.

A block and a chunk are bounded in rows, whatever the number of rows per label. Rows move once per block
of anchors (``anchor_rows`` of them), anchors once per chunk, as integers.

Defined cases: rows with a null label, a null vector, or a null, NaN or infinite component take no part.
Shorter vectors count as padded with zeros. Components saturate at the magnitude where 100 times a score
still fits 64 bits. Every row is a row of its own, also one that repeats an id: it may be the positive of
its twin, and both twins are anchors if their id says so. A row without an id is no anchor and comes after
all others of its score. An anchor without positives, or a positive without negatives, has no rows. An empty
table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripfunnel.llm.centroids import integers
from tripfunnel.llm.common import finite_vector, stored
from tripfunnel.operators.rows import top_n_per_group

#: Sides of a tile: anchors, candidates.
TILE = (512, 4096)
#: Halving stops when a side is no longer than this.
LEAF = 32


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of two leaves. Where no sum can reach 2**53, doubles hold every step exactly and are faster."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` for int64 matrices, exact modulo 2**64, by seven half-size products per level."""
    (n, k), m = a.shape, b.shape[1]
    if min(n, k, m) <= LEAF:
        return _product(a, b)
    even = lambda x: np.pad(x, [(0, s % 2) for s in x.shape])
    a, b = even(a), even(b)
    i, j, l = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    m1 = strassen(a11 + a22, b11 + b22)
    m2 = strassen(a21 + a22, b11)
    m3 = strassen(a11, b12 - b22)
    m4 = strassen(a22, b21 - b11)
    m5 = strassen(a11 + a12, b22)
    m6 = strassen(a21 - a11, b11 + b12)
    m7 = strassen(a12 - a22, b21 + b22)
    out = np.empty((2 * i, 2 * l), dtype=np.int64)
    out[:i, :l] = m1 + m4 - m5 + m7
    out[:i, l:] = m3 + m5
    out[i:, :l] = m2 + m4
    out[i:, l:] = m1 - m2 + m3 + m6
    return out[:n, :m]


class Heaps:
    """For each of some owners, the best ``most`` rows seen: highest score, then smallest id, then row.

    Kept as one sorted array of each field, so that offers are merged by sorting.
    """

    def __init__(self, most: int):
        self.most = most
        none = np.empty(0, dtype=np.int64)
        self.owner, self.score, self.id, self.nameless, self.row = none, none, none, none, none

    def offer(self, owner, score, id_, nameless, row) -> None:
        fields = [
            np.concatenate([old, np.asarray(new, dtype=np.int64)])
            for old, new in zip((self.owner, self.score, self.id, self.nameless, self.row), (owner, score, id_, nameless, row))
        ]
        o, s, i, none, r = fields
        order = np.lexsort((r, i, none, -s, o))
        o = o[order]
        first = np.flatnonzero(np.concatenate([[True], o[1:] != o[:-1]])) if len(o) else o
        rank = np.arange(len(o)) - np.repeat(first, np.diff(np.append(first, len(o))))
        order = order[rank < self.most]
        self.owner, self.score, self.id, self.nameless, self.row = (f[order] for f in fields)


class Side:
    """Anchors or candidates of one task as arrays."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        ids = table.column("id")
        self.row = table.column("row").to_numpy()
        self.nameless = ids.is_null().to_numpy().astype(np.int64)
        self.id = ids.fill_null(0).to_numpy()
        self.label = table.column("label").to_numpy()
        lists = table.column("v").combine_chunks() if len(table) else pa.array([], pa.list_(pa.int32()))
        self.lengths = np.diff(lists.offsets.to_numpy()) if len(table) else np.empty(0, np.int64)
        self.flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        self.table = table

    def vectors(self, width: int) -> np.ndarray:
        out = np.zeros((len(self.row), width), dtype=np.int64)
        inside = np.arange(width)[None] < self.lengths[:, None]
        out[inside] = self.flat
        return out


def _tiles(a: np.ndarray, c: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """Scores of anchors ``a`` with candidates ``c``: where a tile starts in either, and the tile."""
    for i in range(0, len(a), TILE[0]):
        for j in range(0, len(c), TILE[1]):
            yield i, j, strassen(a[i : i + TILE[0]], c[j : j + TILE[1]].T)


def _sides(anchors: pa.Table, candidates: pa.Table) -> tuple[Side, Side, np.ndarray, np.ndarray]:
    a, c = Side(anchors), Side(candidates)
    width = int(max(a.lengths.max(initial=0), c.lengths.max(initial=0)))
    return a, c, a.vectors(width), c.vectors(width)


def _positives(most: int):
    """Of one block and chunk, each anchor's best rows of its own label."""

    def run(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        a, c, av, cv = _sides(anchors, candidates)
        heaps = Heaps(most)
        for label in np.intersect1d(a.label, c.label):
            mine, theirs = np.flatnonzero(a.label == label), np.flatnonzero(c.label == label)
            for i, j, score in _tiles(av[mine], cv[theirs]):
                who, what = mine[i : i + score.shape[0]], theirs[j : j + score.shape[1]]
                other = a.row[who][:, None] != c.row[what][None]
                if score.shape[1] > most:
                    # Nothing below the best but ``most`` - 1 others of the tile can stay; equals may.
                    ranked = np.where(other, score, np.iinfo(np.int64).min)
                    other &= score >= np.partition(ranked, -most, axis=1)[:, -most][:, None]
                x, y = np.nonzero(other)
                at = what[y]
                heaps.offer(who[x], score[x, y], c.id[at], c.nameless[at], c.row[at])
        return _table(heaps, {"anchor": a.row[heaps.owner]})

    return run


def _table(heaps: Heaps, owner: dict[str, np.ndarray]) -> pa.Table:
    ids = pa.array(heaps.id, mask=heaps.nameless.astype(bool))
    columns = {k: pa.array(v, pa.int64()) for k, v in owner.items()}
    return pa.table({**columns, "id": ids, "score": pa.array(heaps.score), "row": pa.array(heaps.row)})


def _negatives(most: int, low: int):
    """Of one block and chunk, for each anchor and positive the best rows of another label in the window."""

    def run(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        a, c, av, cv = _sides(anchors, candidates)
        scores = a.table.column("positives").to_pylist()
        wide = max(map(len, scores), default=0)
        exists = np.array([[n < len(s) for n in range(wide)] for s in scores], dtype=bool).reshape(len(scores), wide)
        positive = np.zeros(exists.shape, dtype=np.int64)
        positive[exists] = [x for s in scores for x in s]
        # A window has its lower end below its upper end only if the positive's score is 0 or more.
        exists &= low * positive <= 100 * positive
        least = np.where(exists, low * positive, np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max)
        highest = np.where(exists, 100 * positive, np.iinfo(np.int64).min).max(axis=1, initial=np.iinfo(np.int64).min)
        heaps = Heaps(most)
        for i, j, score in _tiles(av, cv):
            n, m = score.shape
            hundred = 100 * score
            inside = (hundred >= least[i : i + n, None]) & (hundred <= highest[i : i + n, None])
            inside &= a.label[i : i + n, None] != c.label[None, j : j + m]
            x, y = np.nonzero(inside)
            s, h = score[x, y], hundred[x, y]
            for nth in range(wide):
                p = positive[i + x, nth]
                fits = exists[i + x, nth] & (low * p <= h) & (h <= 100 * p)
                at = j + y[fits]
                heaps.offer((i + x[fits]) * wide + nth, s[fits], c.id[at], c.nameless[at], c.row[at])
        return _table(heaps, {"anchor": a.row[heaps.owner // max(1, wide)], "nth": heaps.owner % max(1, wide) + 1})

    return run


def prepared(
    vectors: DataFrame, id_column: str, vector: str, label: Column, scale: int
) -> DataFrame:
    """The rows that take part: ``row``, ``id``, ``label``, integer vector ``v``; stored."""
    sound = vectors.filter(finite_vector(F.col(vector))).withColumn("__label", label).filter("__label IS NOT NULL")
    longest = sound.agg(F.max(F.size(vector))).first()[0] or 1
    most = math.isqrt((2**63 - 1) // (100 * longest))
    return stored(
        sound.select(
            F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("long").alias("id"),
            F.col("__label").cast("long").alias("label"), integers(F.col(vector), scale, most).alias("v"),
        ),
        "rows",
    )


def mine(
    vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: Column | None = None, scale: int = 256,
    anchor_every: int = 100, positives: int = 5, negatives: int = 5, low: int = 80,
    anchor_rows: int = 16384, chunk_rows: int = 32768,
) -> DataFrame:
    """Per anchor and positive the hardest negatives: ids, ``rank`` and both scores."""
    rows = prepared(vectors, id_column, vector, F.col("label") if label is None else label, scale)
    is_anchor = F.col("id") % anchor_every == 0
    total, anchors = rows.agg(F.count("*"), F.count(F.when(is_anchor, 1))).first()
    blocks, chunks = max(1, -(-anchors // anchor_rows)), max(1, -(-total // chunk_rows))
    spread = lambda n, salt: F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    candidates = rows.select("*", spread(chunks, 1).alias("chunk"), every(blocks).alias("block"))
    key = ["block", "chunk"]

    def meet(owners: DataFrame, work, schema: str) -> DataFrame:
        placed = owners.select("*", spread(blocks, 2).alias("block"), every(chunks).alias("chunk"))
        return stored(placed.groupBy(*key).cogroup(candidates.groupBy(*key)).applyInArrow(work, schema), "heaps")

    best = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("row")]
    # Columns of their own, so that anchors and candidates can be told apart.
    owners = rows.filter(is_anchor).select(*[F.col(c).alias(c) for c in rows.columns])
    found = meet(owners, _positives(positives), "anchor long, id long, score long, row long")
    chosen = stored(
        top_n_per_group(found, ["anchor"], best, positives, "nth").select("anchor", "nth", "id", "score"), "positives"
    )
    # At most ``positives`` numbers per anchor.
    lists = chosen.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("nth", "score"))).alias("list")).select(
        F.col("anchor").alias("row"), F.col("list.score").alias("positives")
    )
    found = meet(
        owners.join(lists, "row"), _negatives(negatives, low), "anchor long, nth long, id long, score long, row long"
    )
    ranked = top_n_per_group(found, ["anchor", "nth"], best, negatives, "rank")
    names = owners.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return (
        ranked.select("anchor", "nth", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
        .join(chosen.select("anchor", F.col("nth").cast("long").alias("nth"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), ["anchor", "nth"])
        .join(names, "anchor")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )

"""SimHash near-duplicates: segment popcounts, a grid join under Manhattan distance, an exact check.

The fingerprint of a text has a bit set where more than half of its shingle hashes (XXH64, seed 42)
have it set. The 64 bits are cut into 32 segments of two bits; the number of set bits in each segment
is a point in {0, 1, 2}^32. One differing bit moves that point by one step along one axis, so the
Manhattan distance of two points never exceeds the Hamming distance of the fingerprints.

The grid join finds all pairs of points within Manhattan distance ``max_bits``. The axes are cut into
``max_bits // 2 + 1`` parts, so in one part two such points differ by one step at most, along one axis.
The axes of a part form blocks, and all blocks but one must be equal there: a grid cell is one part,
the block left out, and the coordinates on the rest. Points that share a cell are compared by Manhattan
distance, and what passes by the exact number of differing bits.

Equal fingerprints are one point, so copies cost nothing. Points in a cell are compared in blocks; a
cell of more than ``cell_rows`` points is spread over pairs of blocks, each a group of its own. Each
group returns its links as a forest of at most one row per point, never its pairs.

Defined cases: a text without words (null, empty, blank) has fingerprint zero and links like any other;
a text of fewer words than a shingle is one shingle. A null id never is a component's name: a component
of null ids alone has a null name. Equal rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripfunnel.llm.common import annotate, free_name, stored
from tripfunnel.llm.components import components, local_roots
from tripfunnel.llm.words import parts

EVEN = np.uint64(0x5555555555555555)
ONE = np.uint64(1)


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The words are taken some megabytes at a time, the last ones of a part again with the next."""
    data = b"" if text is None else text.encode().lower()  # on bytes, only A to Z change
    digest = xxhash.xxh64_intdigest
    counts, n = np.zeros(64, dtype=np.int64), 0
    carried: list[bytes] = []
    for words in parts(data):
        words = carried + words
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
        n += _count_bits(np.array([digest(s, 42) for s in shingles], dtype="<u8"), counts)
        carried = words[max(0, len(words) - shingle + 1) :]
    if not n and carried:
        n = _count_bits(np.array([digest(b" ".join(carried), 42)], dtype="<u8"), counts)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _count_bits(hashes: np.ndarray, counts: np.ndarray) -> int:
    """Adds the set bits of the hashes to ``counts``; returns how many hashes there are."""
    for i in range(0, len(hashes), 65536):
        bits = np.unpackbits(hashes[i : i + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return len(hashes)


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, dtype=np.uint64).view(np.int64)


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3) -> tuple[DataFrame, str]:
    """``docs`` with the fingerprint as a signed long, and that column's name."""
    name = free_name(docs, "fp")

    def work():
        return lambda texts: _signed([fingerprint(t, shingle) for t in texts])

    return annotate(docs, text, work, name, T.LongType()), name


def hex16(fp) -> F.Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def popcounts(fp: np.ndarray) -> np.ndarray:
    """The 32 popcounts in unary (0: 00, 1: 01, 2: 11), so that differing bits count Manhattan steps."""
    high = (fp >> ONE) & EVEN
    low = fp & EVEN
    return (low | high) | ((low & high) << ONE)


def cell_masks(max_bits: int, blocks: int) -> list[tuple[int, int]]:
    """Number and mask of every cell family: one part of the axes without one of its blocks."""
    parts = max_bits // 2 + 1
    axes = np.array_split(np.arange(32), parts)
    out = []
    for part in axes:
        for block in np.array_split(part, min(blocks, len(part))):
            chosen = sorted(set(part.tolist()) - set(block.tolist()))
            out.append((len(out), sum(3 << (2 * int(axis)) for axis in chosen)))
    return out


def _cells(points: DataFrame, max_bits: int, blocks: int) -> DataFrame:
    """A row for every point and cell family: ``cell`` is the family and the point's coordinates there."""
    fp, even = F.col("fp"), F.lit(int(EVEN))
    high = F.shiftrightunsigned(fp, 1).bitwiseAND(even)
    low = fp.bitwiseAND(even)
    unary = low.bitwiseOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))
    signed = lambda mask: int(np.uint64(mask).astype(np.int64))
    families = [
        F.struct(F.lit(n).alias("family"), unary.bitwiseAND(F.lit(signed(mask))).alias("place"))
        for n, mask in cell_masks(max_bits, blocks)
    ]
    return points.select("fp", F.explode(F.array(*families)).alias("c")).select("fp", "c.family", "c.place")


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _forest(points: np.ndarray, group: np.ndarray, side: np.ndarray, across: np.ndarray, max_bits: int):
    """Links of whole groups (sorted by group), as a forest: node and least node of its tree."""
    unary = popcounts(points)
    n = len(points)
    left, right, held = [], [], 0
    step = 1
    start = np.arange(n)

    def compress():
        a, b = np.concatenate(left), np.concatenate(right)
        root = local_roots(n, a, b)
        moved = np.flatnonzero(root != np.arange(n))
        return [moved], [root[moved]], len(moved)

    while True:
        start = start[start + step < n]
        start = start[group[start] == group[start + step]]
        if not len(start):
            break
        a, b = start, start + step
        fit = ~across[a] | (side[a] != side[b])
        a, b = a[fit], b[fit]
        near = np.bitwise_count(unary[a] ^ unary[b]) <= max_bits
        a, b = a[near], b[near]
        exact = np.bitwise_count(points[a] ^ points[b]) <= max_bits
        left.append(a[exact])
        right.append(b[exact])
        held += int(exact.sum())
        if held > 4 * n + 100_000:
            left, right, held = (x for x in compress())
        step += 1
    if not left or not held:
        return points[:0], points[:0]
    (a,), (b,), _ = compress()
    return points[a], points[b]


def _link_groups(max_bits: int):
    def run(batches):
        kept = None
        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            if kept is not None:
                columns = [np.concatenate([k, c]) for k, c in zip(kept, columns)]
            family, place, pair, fp, side = columns
            if not len(fp):
                continue
            change = (np.diff(family) != 0) | (np.diff(place) != 0) | (np.diff(pair) != 0)
            group = np.concatenate([[0], np.cumsum(change)])
            whole = int(np.searchsorted(group, group[-1]))  # the last group may go on in the next batch
            kept = [c[whole:] for c in columns]
            yield links(fp[:whole], group[:whole], side[:whole], pair[:whole])
        if kept is not None and len(kept[3]):
            yield links(kept[3], np.zeros(len(kept[3]), dtype=np.int64), kept[4], kept[2])

    def links(fp, group, side, pair):
        a, b = _forest(fp.view(np.uint64), group, side, pair % 2 == 1, max_bits)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], schema=LINKS)

    return run


def link_forest(points: DataFrame, max_bits: int = 3, blocks: int = 4, cell_rows: int = 4096) -> DataFrame:
    """Links ``a``, ``b`` between the distinct ``fp`` of ``points`` that connect all within ``max_bits``.

    Groups of up to ``cell_rows`` points are compared as they are. A larger cell is cut into blocks by
    hash, and every pair of its blocks is a group; ``pair`` numbers those, odd if only points of
    different blocks still have to meet.
    """
    cells = _cells(points, max_bits, blocks)
    large = stored(
        cells.groupBy("family", "place").count().filter(F.col("count") > cell_rows)
        .select("family", "place", F.ceil(2 * F.col("count") / cell_rows).alias("parts")),
        "large-cells",
    )
    marked = cells.join(large, ["family", "place"], "left")
    own = F.pmod(F.xxhash64("fp", "family"), F.col("parts"))
    small = marked.filter("parts IS NULL").select(
        "family", "place", F.lit(0).cast("long").alias("pair"), "fp", F.lit(0).cast("long").alias("side")
    )
    split = (
        marked.filter("parts IS NOT NULL").withColumn("own", own)
        .select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("other"))
        .select(
            "family", "place",
            (
                2 * (F.least("own", "other") * F.col("parts") + F.greatest("own", "other"))
                + F.when(F.col("own") == F.col("other"), 0).otherwise(1)
            ).alias("pair"),
            "fp", F.col("own").alias("side"),
        )
    )
    groups = small.unionByName(split) if large.head(1) else small
    return (
        groups.repartition("family", "place", "pair")
        .sortWithinPartitions("family", "place", "pair", "fp")
        .mapInArrow(_link_groups(max_bits), "a long, b long")
    )


def near_duplicates(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", shingle: int = 3, max_bits: int = 3,
    blocks: int = 4, cell_rows: int = 4096,
) -> DataFrame:
    """One row per document: the id, ``fp`` and ``component_id``, the least id of its component."""
    marked, fp = fingerprints(docs.select(F.col(id_column).alias("id"), F.col(text).alias("text")), "text", shingle)
    marked = stored(marked.select("id", F.col(fp).alias("fp")), "fingerprints")
    named = _components_of(marked, max_bits, blocks, cell_rows)
    return marked.join(named, "fp").select(F.col("id").alias(id_column), "fp", "component_id")


def _components_of(marked: DataFrame, max_bits: int, blocks: int, cell_rows: int) -> DataFrame:
    """``fp`` and the least ``id`` of its component, for all fingerprints of ``marked``."""
    points = stored(marked.groupBy("fp").agg(F.min("id").alias("least")), "points")
    joined = stored(components(link_forest(points.select("fp"), max_bits, blocks, cell_rows)), "components")
    rooted = points.join(joined, points["fp"] == joined["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(names, "root").select("fp", "component_id")


def keep_one(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", shingle: int = 3, max_bits: int = 3,
    blocks: int = 4, cell_rows: int = 4096,
) -> DataFrame:
    """The rows of ``docs``, one of each component: the one with the least id, of equal ids any one."""
    marked, fp = fingerprints(docs, text, shingle)
    row = free_name(marked, "row")
    marked = stored(marked.withColumn(row, F.monotonically_increasing_id()), "fingerprinted")
    ids = marked.select(F.col(id_column).alias("id"), F.col(fp).alias("fp"), F.col(row).alias("row"))
    # Row numbers of the stored table stand in for ids, so that null and repeated ids are told apart.
    numbered = ids.select("fp", F.struct(F.col("id").isNull().alias("none"), "id", "row").alias("id"))
    named = _components_of(numbered, max_bits, blocks, cell_rows)
    chosen = named.select(F.col("component_id.row").alias("__row")).distinct()
    kept = marked.join(chosen, F.col(row) == F.col("__row"), "left_semi")
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])

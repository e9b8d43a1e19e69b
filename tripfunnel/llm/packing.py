"""Packing by optimal length buckets and token-budget batches.

Texts are measured in words and cut into pieces of at most ``max_length`` words, so no word is lost and
the global histogram of piece lengths has at most ``max_length + 1`` rows, whatever the input. Dynamic
programming over that histogram chooses at most ``buckets`` boundaries with the least padding: every
piece is padded to the boundary of its bucket. Inside a bucket, pieces are numbered without gaps and
every ``budget // boundary`` of them form one batch, so a batch never exceeds ``budget`` padded words.

The order inside a bucket is by hash of id and piece, so it repeats on every run and mixes sources. It
is numbered in cells of about ``cell_rows`` rows, whose counts are summed up first: no task ever holds
a bucket.

Defined cases: a null or blank text is one piece of length 0; rows without an id and repeated rows are
packed one by one like any other; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripfunnel.llm.common import stored

WORD = r"[^\x20\x09-\x0D]+"


def choose_boundaries(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """At most ``buckets`` of the lengths as upper ends of buckets, with the least padding in sum.

    Of equal choices the one with fewer buckets, then with smaller boundaries from the end on, is taken.
    """
    if not lengths:
        return []
    order = np.argsort(lengths)
    length = np.array(lengths, dtype=np.float64)[order]
    many = np.concatenate([[0.0], np.cumsum(np.array(counts, dtype=np.float64)[order])])
    words = np.concatenate([[0.0], np.cumsum(np.array(counts, dtype=np.float64)[order] * length)])
    n = len(length)
    buckets = min(buckets, n)
    best = np.full((buckets + 1, n + 1), np.inf)
    best[0, 0] = 0.0
    cut = np.zeros((buckets + 1, n + 1), dtype=np.int64)
    for k in range(1, buckets + 1):
        for end in range(1, n + 1):
            padding = length[end - 1] * (many[end] - many[:end]) - (words[end] - words[:end])
            total = best[k - 1, :end] + padding
            cut[k, end] = np.argmin(total)
            best[k, end] = total[cut[k, end]]
    k, end, out = int(np.argmin(best[:, n])), n, []
    while end:
        out.append(int(length[end - 1]))
        end = int(cut[k, end])
        k -= 1
    return out[::-1]


def pieces(docs: DataFrame, text: str = "text", id_column: str = "doc_id", max_length: int = 2048) -> DataFrame:
    """``doc``, ``row``, ``piece``, ``start`` (first word, from 0) and ``length`` (words) of every piece."""
    measured = docs.select(
        F.col(id_column).alias("doc"),
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("words"),
    )
    last = F.greatest(F.ceil(F.col("words") / max_length) - 1, F.lit(0))
    return (
        stored(measured, "words")
        .select("*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
        .withColumn("start", F.col("piece") * max_length)
        .withColumn("length", F.least(F.col("words") - F.col("start"), F.lit(max_length).cast("long")))
        .drop("words")
    )


def _pick(index: Column, values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])[index]


def pack(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", buckets: int = 8, budget: int = 16384,
    max_length: int = 2048, cell_rows: int = 20000,
) -> DataFrame:
    """One row per piece: id, ``piece``, ``start``, ``length``, ``bucket``, ``boundary``, ``batch``, ``slot``.

    ``batch`` numbers the batches of a bucket from 0, ``slot`` the pieces of a batch from 0.
    """
    cut = pieces(docs, text, id_column, max_length)
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().toLocalIterator()}
    boundaries = choose_boundaries(list(histogram), list(histogram.values()), buckets) or [max_length]
    inside = np.searchsorted(boundaries, list(histogram)) if histogram else []
    filled = np.bincount(inside, weights=list(histogram.values()), minlength=len(boundaries)) if histogram else [0]
    bucket = sum((F.when(F.col("length") > b, 1).otherwise(0) for b in boundaries[:-1]), F.lit(0))
    per_batch = [max(1, budget // max(1, b)) for b in boundaries]
    cells = [max(1, int(np.ceil(n / cell_rows))) for n in filled]
    key = F.when(F.col("doc").isNull(), F.xxhash64("row", "piece")).otherwise(F.xxhash64("doc", "piece"))
    placed = cut.withColumn("bucket", bucket).withColumn("cell", F.pmod(key, _pick(F.col("bucket"), cells)))
    counted = placed.groupBy("bucket", "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("bucket").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select("bucket", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inner = Window.partitionBy("bucket", "cell").orderBy(key, "doc", "piece", "row")
    numbered = placed.withColumn("inner", F.row_number().over(inner) - 1).join(offsets, ["bucket", "cell"])
    rank, size = F.col("offset") + F.col("inner"), _pick(F.col("bucket"), per_batch)
    return numbered.select(
        F.col("doc").alias(id_column), "piece", "start", "length", "bucket",
        _pick(F.col("bucket"), boundaries).alias("boundary"),
        F.floor(rank / size).cast("long").alias("batch"),
        F.pmod(rank, size).cast("int").alias("slot"),
    )

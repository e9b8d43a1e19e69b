"""Sharding by sampled splitters: size-weighted key samples, quantile ranges, overfull ranges subdivided.

The key of a record is the hash of its text, so equal texts lie side by side. Keys are drawn with a
chance in proportion to their record's size; the quantiles of that sample cut the keys into ranges of
about equal bytes, many to a shard, and a key that the sample shows to be heavy gets a range of its
own. The bytes and rows of every range are then counted over all records. A range that turns out
overfull is subdivided: by id if it is one key (a third of all rows may be one text), else by key.

Running sums over the counted ranges, and inside each range, place every record exactly on the line of
all bytes, and the line is cut into equal shards. Equal texts stay in one shard unless they weigh more
than ``slack`` of a shard or a range was split between them; so two shards differ by about that much.

The law is ``bytes``: sizes near equal. Records move once, as a few numbers; texts do not move.

Defined cases: a null text has size 1 and the checksum of no bytes; a null id sorts first; repeated rows
are records of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripfunnel.llm.common import stored

LAW = "bytes"


def splitters(keys: np.ndarray, weights: np.ndarray, ranges: int) -> np.ndarray:
    """Lower ends of all ranges but the first, from a sample of keys and the bytes each stands for."""
    if not len(keys):
        return keys
    distinct, inverse = np.unique(keys, return_inverse=True)
    weight = np.bincount(inverse, weights=weights)
    ideal = weight.sum() / ranges
    heavy = distinct[weight >= ideal]
    light = weight * (weight < ideal)
    end = np.cumsum(light)
    at = np.searchsorted(end, np.arange(1, ranges) * ideal)
    ends = distinct[np.unique(at[at < len(distinct)])]
    after = heavy[heavy < np.iinfo(np.int64).max] + 1
    return np.unique(np.concatenate([ends, heavy, after])).astype(np.int64)


def _range_of(cuts: np.ndarray):
    def run(batches):
        for batch in batches:
            key = batch.column(batch.schema.get_field_index("key")).to_numpy()
            found = np.searchsorted(cuts, key, side="right")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())], names=[*batch.schema.names, "range"])

    return run


def records(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Id, ``size``, ``text_crc32``, ``key`` and a row number of every document, stored."""
    utf8 = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return stored(
        docs.select(
            F.col(id_column).alias("id"),
            (F.octet_length(utf8) + 1).cast("long").alias("size"),
            F.crc32(utf8).alias("text_crc32"),
            F.xxhash64(F.col(text)).alias("key"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "records",
    )


def cells(found: DataFrame, shards: int, ranges_per_shard: int, range_rows: int, draws: int) -> DataFrame:
    """The records with ``range`` and ``part``: cells of about equal bytes, in the order of keys."""
    total = found.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.count("*").alias("rows")).first()
    ranges = max(shards * ranges_per_shard, -(-total["rows"] // range_rows))
    # A record is drawn if a number between 0 and 1, hashed from its id and row, is below its chance.
    step = max(1.0, total["bytes"] / (ranges * draws))
    chance = F.pmod(F.xxhash64("id", "row", F.lit("draw")), F.lit(1 << 30)) / float(1 << 30)
    drawn = found.filter(chance * step < F.col("size")).select("key", F.greatest("size", F.lit(step)).alias("weight")).toArrow()
    cuts = splitters(drawn.column("key").to_numpy(), drawn.column("weight").to_numpy(), ranges)
    placed = stored(
        found.mapInArrow(_range_of(cuts), T.StructType([*found.schema.fields, T.StructField("range", T.LongType())])), "ranges"
    )
    ideal = max(1.0, total["bytes"] / ranges)
    weighed = placed.groupBy("range").agg(F.sum("size").alias("b"), F.min("key").alias("low"), F.max("key").alias("high"))
    overfull = weighed.filter(F.col("b") > 1.5 * ideal).select(
        "range", F.ceil(F.col("b") / ideal).alias("parts"), (F.col("low") == F.col("high")).alias("one_key")
    )
    by = F.when(F.col("one_key"), F.xxhash64("id", "row")).otherwise(F.xxhash64("key"))
    return (
        placed.join(overfull, "range", "left")
        .withColumn("part", F.coalesce(F.pmod(by, F.col("parts")), F.lit(0)))
        .drop("parts", "one_key")
    )


def assign(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", shards: int = 8, slack: float = 0.004,
    ranges_per_shard: int = 64, range_rows: int = 200_000, draws: int = 16,
) -> DataFrame:
    """One row per document: id, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``, ``row``."""
    found = records(docs, text, id_column)
    placed = stored(cells(found, shards, ranges_per_shard, range_rows, draws), "cells")
    total = placed.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    counted = placed.groupBy("range", "part").agg(F.sum("size").alias("b"), F.count("*").alias("n"))
    # One row per range: a bounded number at a time in one task, some tens of bytes each.
    before = Window.orderBy("range", "part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select(
        "range", "part", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"),
    )
    cell = Window.partitionBy("range", "part").orderBy("key", "id", "row")
    group = Window.partitionBy("range", "part", "key")
    running = cell.rowsBetween(Window.unboundedPreceding, -1)
    line = (
        placed.withColumn("ahead", F.coalesce(F.sum("size").over(running), F.lit(0)))
        .withColumn("place", F.row_number().over(cell) - 1)
        .withColumn("group_bytes", F.sum("size").over(group))
        .withColumn("group_ahead", F.min("ahead").over(group))
        .join(offsets, ["range", "part"])
    )
    whole = F.col("group_bytes") <= slack * total / shards
    start = F.col("bytes_before") + F.when(whole, F.col("group_ahead") + F.col("group_bytes") / 2).otherwise(
        F.col("ahead") + F.col("size") / 2
    )
    share = F.least(F.floor(start * shards / max(1, total)), F.lit(shards - 1))
    line = stored(
        line.select(
            "id", "size", "text_crc32", "row", share.cast("int").alias("shard"),
            (F.col("rows_before") + F.col("place")).alias("place"),
        ),
        "line",
    )
    firsts = line.groupBy("shard").agg(F.min("place").alias("first"))  # one row per shard
    return line.join(F.broadcast(firsts), "shard").select(
        F.col("id").alias(id_column), "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
        (F.col("place") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "row",
    )


def write_shards(docs: DataFrame, path: str, text: str = "text", id_column: str = "doc_id", **options) -> DataFrame:
    """``docs`` written as one folder per shard, in the order of ``slot``; returns what was written."""
    kept = stored(docs.withColumn("__row", F.monotonically_increasing_id()), "sharded")
    places = assign(
        kept.select(F.col(text).alias("text"), F.struct("__row", F.col(id_column).alias("own")).alias("id")), "text", "id", **options
    ).select(F.col("id.__row").alias("__row"), "shard", "slot")
    ordered = kept.join(places, "__row").drop("__row").repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.parquet(path)

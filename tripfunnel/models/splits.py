"""Seeded train/test splits that do not depend on row order or partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _digest(key: Column, seed: int) -> Column:
    return F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")).cast("binary"))


def stratified_split(
    df: DataFrame, label: str, key: str, test_fraction: float = 0.2, seed: int = 42
) -> DataFrame:
    """Adds ``is_test``: in every class the rows with the smallest key digests, exactly
    ``test_fraction`` of the class (rounded half up).

    Rows are ranked inside 4096 digest buckets per class and shifted by the bucket
    counts, so a class with most of the rows is still ranked in parallel.
    """
    marked = df.withColumn("_digest", _digest(F.col(key), seed)).withColumn(
        "_bucket", F.substring("_digest", 1, 3)
    )
    counts = marked.groupBy(label, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    by_class = Window.partitionBy(label)
    before = by_class.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col(label).alias("_label"),
        F.col("_bucket").alias("_b"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.floor(F.sum("_n").over(by_class) * test_fraction + 0.5).alias("_tests"),
    )
    inside = Window.partitionBy(label, "_bucket").orderBy("_digest", key)
    ranked = marked.withColumn("_nth", F.row_number().over(inside))
    return ranked.join(
        offsets, F.col(label).eqNullSafe(F.col("_label")) & (F.col("_bucket") == F.col("_b"))
    ).select(*df.columns, (F.col("_before") + F.col("_nth") <= F.col("_tests")).alias("is_test"))


def user_holdout(
    df: DataFrame, user: str = "user_id", test_fraction: float = 0.2, seed: int = 42
) -> DataFrame:
    """Adds ``is_test`` per user from the user's digest alone: no shuffle, and a user
    stays on the same side as the data grows.
    """
    position = F.conv(F.substring(_digest(F.col(user), seed), 1, 8), 16, 10).cast("long")
    return df.withColumn("is_test", position < int(test_fraction * 2**32))

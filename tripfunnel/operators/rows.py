"""Row-selection operators and joins that hold up under hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every group in the given order.

    The rank filter lets Spark keep one row per key and task before the shuffle,
    so a key that fills a third of the table moves only a handful of rows.
    """
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_nth", nth).filter(F.col("_nth") == 1).drop("_nth")


def top_n_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank"
) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(rank, nth).filter(F.col(rank) <= n)


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest version per key: largest ``order`` columns, nulls last."""
    return first_per_group(df, keys, [F.col(c).desc_nulls_last() for c in order])


def left_join_many(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str,
    present: DataFrame | None = None,
) -> DataFrame:
    """Left join where one left row may match very many right rows.

    A plain left join cannot be rescued from a hot key on its right side: only the
    preserved side may be split. The inner join can be split on both sides by the
    skew-join rule, and the rows without a match come from an anti join against the
    distinct keys, which are combined before they are shuffled. Both joins read the same
    shuffle of the left side. Left rows without a key are added without any join.

    ``present`` is a cheaper source of the right keys where ``right`` is a join itself.
    """
    keyed = left.filter(F.col(left_key).isNotNull())
    keys = (
        (right if present is None else present)
        .select(F.col(right_key).alias("_present"))
        .filter(F.col("_present").isNotNull())
        .distinct()
    )
    matched = keyed.join(right, F.col(left_key) == F.col(right_key), "inner")
    alone = keyed.join(keys, F.col(left_key) == F.col("_present"), "left_anti")
    keyless = left.filter(F.col(left_key).isNull())
    return matched.unionByName(alone, allowMissingColumns=True).unionByName(
        keyless, allowMissingColumns=True
    )


def search_text(df: DataFrame, column: str, term: str) -> DataFrame:
    """Case-insensitive substring search; a blank term keeps everything."""
    if not term.strip():
        return df
    return df.filter(F.lower(column).contains(term.lower()))


def recent(df: DataFrame, ts: str, hours: float, as_of: Column) -> DataFrame:
    return df.filter(F.col(ts) >= as_of - F.make_dt_interval(secs=F.lit(hours * 3600)))

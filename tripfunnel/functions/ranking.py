"""Ranking metrics over rows or over array columns.

Rows: ``list_measures`` takes ranked items and relevant items per key as rows and never
builds a list; the metrics ``..._of`` read its result. Arrays, for lists that are short:
``predicted`` is a ranked array, ``actual`` the relevant items. The per-list metrics are
column expressions; the list-of-lists metrics are aggregates.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _empty(items: Column) -> Column:
    return items.isNull() | (F.size(items) <= 0)


def _top(predicted: Column, k: int) -> Column:
    return F.slice(predicted, 1, k)


def _hits(predicted: Column, actual: Column, k: int) -> Column:
    return F.size(F.array_intersect(_top(predicted, k), actual))


def _guard(predicted: Column, actual: Column, value: Column) -> Column:
    return F.when(_empty(predicted) | _empty(actual), F.lit(0.0)).otherwise(value)


def precision_at_k(predicted: Column, actual: Column, k: int = 10) -> Column:
    """Hits over ``k``, also when fewer than ``k`` items were predicted."""
    return _guard(predicted, actual, _hits(predicted, actual, k) / F.lit(float(k)))


def recall_at_k(predicted: Column, actual: Column, k: int = 10) -> Column:
    return _guard(
        predicted,
        actual,
        _hits(predicted, actual, k).cast("double") / F.size(F.array_distinct(actual)),
    )


def _gain(position: Column) -> Column:
    return F.lit(1.0) / F.log2(position + F.lit(2.0))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def ndcg_at_k(predicted: Column, actual: Column, k: int = 10) -> Column:
    """The ideal ranking is as long as ``actual``, repeated entries included."""
    gained = _total(
        F.transform(
            _top(predicted, k),
            lambda item, i: F.when(F.array_contains(actual, item), _gain(i)).otherwise(0.0),
        )
    )
    length = F.least(F.size(actual), F.lit(k))
    ideal = _total(F.transform(F.sequence(F.lit(0), length - 1), _gain))
    return _guard(predicted, actual, gained / ideal)


def average_precision_at_k(predicted: Column, actual: Column, k: int = 10) -> Column:
    """Null without relevant items, so that an average skips the list."""
    start = F.struct(F.lit(0).alias("rank"), F.lit(0).alias("hits"), F.lit(0.0).alias("total"))

    def step(acc: Column, item: Column) -> Column:
        rank = acc["rank"] + 1
        hit = F.array_contains(actual, item)
        hits = acc["hits"] + F.when(hit, 1).otherwise(0)
        gain = F.when(hit, hits.cast("double") / rank).otherwise(0.0)
        return F.struct(
            rank.alias("rank"), hits.alias("hits"), (acc["total"] + gain).alias("total")
        )

    total = F.aggregate(_top(predicted, k), start, step, lambda acc: acc["total"])
    ideal = F.least(F.size(F.array_distinct(actual)), F.lit(k))
    return F.when(~_empty(actual), F.coalesce(total, F.lit(0.0)) / ideal)


def map_at_k(lists: DataFrame, predicted: str, actual: str, k: int = 10) -> DataFrame:
    return lists.agg(
        F.coalesce(
            F.avg(average_precision_at_k(F.col(predicted), F.col(actual), k)), F.lit(0.0)
        ).alias("map_at_k")
    )


def hit_rate(lists: DataFrame, predicted: str, actual: str, k: int = 10) -> DataFrame:
    """Share of all lists with a hit; lists without relevant items count as misses."""
    hit = F.coalesce(_hits(F.col(predicted), F.col(actual), k) > 0, F.lit(False))
    return lists.agg(
        F.coalesce(F.count_if(hit) / F.count(F.lit(1)).cast("double"), F.lit(0.0)).alias("hit_rate")
    )


def coverage(
    lists: DataFrame, predicted: str, catalog: DataFrame, item: str, k: int = 10
) -> DataFrame:
    """Distinct items in the top ``k`` over the size of the catalogue."""
    shown = (
        lists.select(F.explode(_top(F.col(predicted), k)).alias("_item"))
        .distinct()
        .agg(F.count(F.lit(1)).alias("shown"))
    )
    offered = catalog.select(item).distinct().agg(F.count(F.lit(1)).alias("offered"))
    return offered.select(
        F.when(F.col("offered") > 0, shown.scalar() / F.col("offered").cast("double"))
        .otherwise(F.lit(0.0))
        .alias("coverage")
    )


def list_measures(
    predicted: DataFrame, actual: DataFrame, key: str, item: str, rank: str = "rank", k: int = 10
) -> DataFrame:
    """Per key of either side: ``predicted`` (items in the top ``k``), ``relevant`` (distinct),
    ``listed`` (with repeats), ``hits``, ``dcg`` and ``precisions`` (summed over the hits).

    ``predicted`` has a row per key and ranked item (ranks from 1, without ties), ``actual``
    a row per occurrence. Occurrences are counted before they are shuffled, so a key with
    a third of all rows costs its distinct items; the only window sees ``k`` rows per key.
    """
    counts = actual.groupBy(key, item).agg(F.count(F.lit(1)).alias("_n"))
    totals = counts.groupBy(key).agg(F.count(F.lit(1)).alias("relevant"), F.sum("_n").alias("listed"))
    top = predicted.filter(F.col(rank) <= k).select(key, item, F.col(rank).alias("_rank"))
    marked = top.join(counts, [key, item], "left").withColumn(
        "_hit", F.col("_n").isNotNull().cast("long")
    )
    so_far = F.sum("_hit").over(Window.partitionBy(key).orderBy("_rank"))
    ranked = marked.withColumn("_so_far", so_far).groupBy(key).agg(
        F.count(F.lit(1)).alias("predicted"),
        F.sum("_hit").alias("hits"),
        F.sum(F.col("_hit") / F.log2(F.col("_rank") + F.lit(1.0))).alias("dcg"),
        F.sum(F.col("_hit") * F.col("_so_far") / F.col("_rank")).alias("precisions"),
    )
    return ranked.join(totals, key, "full_outer").na.fill(
        0, ["predicted", "hits", "dcg", "precisions", "relevant", "listed"]
    )


def _usable(value: Column) -> Column:
    both = (F.col("predicted") > 0) & (F.col("relevant") > 0)
    return F.when(both, value).otherwise(F.lit(0.0))


def precision_of(k: int = 10) -> Column:
    return _usable(F.col("hits") / F.lit(float(k)))


def recall_of(k: int = 10) -> Column:
    return _usable(F.col("hits").cast("double") / F.col("relevant"))


def ndcg_of(k: int = 10) -> Column:
    """The ideal ranking is as long as the relevant occurrences, repeats included."""
    ideal = [sum(1.0 / log2(i + 2) for i in range(n)) for n in range(1, k + 1)]
    length = F.least(F.col("listed"), F.lit(k)).cast("int")
    return _usable(F.col("dcg") / F.get(F.array(*map(F.lit, ideal)), length - 1))


def map_of(measures: DataFrame, k: int = 10) -> DataFrame:
    """Mean over the keys that have relevant items."""
    average = F.col("precisions") / F.least(F.col("relevant"), F.lit(k))
    mean = F.avg(F.when(F.col("relevant") > 0, average))
    return measures.agg(F.coalesce(mean, F.lit(0.0)).alias("map_at_k"))


def hit_rate_of(measures: DataFrame) -> DataFrame:
    share = F.count_if(F.col("hits") > 0) / F.count(F.lit(1)).cast("double")
    return measures.agg(F.coalesce(share, F.lit(0.0)).alias("hit_rate"))


def coverage_of(predicted: DataFrame, catalog: DataFrame, shown: str, item: str, rank: str = "rank", k: int = 10) -> DataFrame:
    """Distinct items in the top ``k`` over the size of the catalogue."""
    top = predicted.filter(F.col(rank) <= k).agg(F.countDistinct(shown).alias("shown"))
    offered = catalog.agg(F.countDistinct(item).alias("offered"))
    return offered.select(
        F.when(F.col("offered") > 0, top.scalar() / F.col("offered").cast("double"))
        .otherwise(F.lit(0.0))
        .alias("coverage")
    )

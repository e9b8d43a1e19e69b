"""Stored raw and staging tables for the registered queries.

The raw layer is a stored table in any deployment, so it is written once per
application and source folder, and the queries read it from there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripfunnel.operators import staging
from tripfunnel.session import scratch_path, use_utc
from tripfunnel.sources.events_adapter import raw_events
from tripfunnel.sources.id_index import IdIndex

KINDS = ("search", "click", "conversion")

_stored: dict[tuple, str] = {}


def _store(spark: SparkSession, key: tuple, build, partition_by: tuple[str, ...] = ()) -> str:
    key = (spark.sparkContext.applicationId, *key)
    if key not in _stored:
        path = scratch_path(spark, "-".join(str(k) for k in key[2:]))
        build().write.partitionBy(*partition_by).parquet(path)
        _stored[key] = path
    return _stored[key]


def raw(spark: SparkSession, sf_dir: str, kind: str, gap: int = 1440) -> DataFrame:
    """The stored raw table of one event kind."""
    use_utc(spark)
    path = _store(
        spark, (sf_dir, "raw", gap), lambda: raw_events(spark, sf_dir, gap), ("kind",)
    )
    return spark.read.parquet(path).filter(F.col("kind") == kind).drop("kind")


def known_ids(spark: SparkSession, sf_dir: str, before: str) -> IdIndex:
    """The index of the searches ingested before a time."""
    key = (spark.sparkContext.applicationId, sf_dir, "known-ids", before)
    if key not in _stored:
        index = IdIndex(spark, scratch_path(spark, "known-ids"))
        early = F.col("ingested_at") < F.lit(before).cast("timestamp")
        index.rebuild(raw(spark, sf_dir, "search").filter(early))
        _stored[key] = index.path
    return IdIndex(spark, _stored[key])


def staged(spark: SparkSession, sf_dir: str, kind: str, gap: int = 1440) -> DataFrame:
    """The stored staging table of one event kind."""
    path = _store(
        spark,
        (sf_dir, f"stg_{kind}", gap),
        lambda: staging.stage(raw(spark, sf_dir, kind, gap), kind),
    )
    return spark.read.parquet(path)


def model(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A stored model, as the rules and counts of a deployment read it."""
    return spark.read.parquet(_store(spark, (sf_dir, name), build))


def all_staged(spark: SparkSession, sf_dir: str, gap: int = 1440) -> tuple[DataFrame, ...]:
    return tuple(staged(spark, sf_dir, kind, gap) for kind in KINDS)

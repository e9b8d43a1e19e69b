"""Session grain: searches, clicks and conversions of one session in one row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripfunnel.functions.scalar import minutes_between, ratio

CONTEXT = ("platform", "device_type", "geo_country", "utm_source", "utm_campaign")


def session_searches(searches: DataFrame) -> DataFrame:
    """Search measures and opening context in one aggregation, so one exchange.

    Searches without a session id form one group, which has no context to look up. A
    search without a time opens a session only if none of its searches has one.
    """
    timeless = F.col("event_timestamp").isNull().alias("timeless")
    opening = F.when(
        F.col("session_id").isNotNull(), F.struct(timeless, "event_timestamp", "event_id")
    )
    return searches.groupBy("session_id").agg(
        F.min("event_timestamp").alias("session_start"),
        F.max("event_timestamp").alias("session_end"),
        F.count(F.lit(1)).alias("search_count"),
        F.countDistinct("search_query").alias("unique_queries"),
        F.max("user_id").alias("user_id"),
        F.min_by(F.struct(*CONTEXT), opening).alias("_context"),
    )


def session_clicks(clicks: DataFrame) -> DataFrame:
    return (
        clicks.filter(F.col("session_id").isNotNull())
        .groupBy("session_id")
        .agg(
            F.count(F.lit(1)).alias("click_count"),
            F.avg("result_position").alias("avg_click_position"),
            F.sum("result_price").alias("total_clicked_value"),
        )
    )


def session_conversions(conversions: DataFrame) -> DataFrame:
    return (
        conversions.filter(F.col("session_id").isNotNull())
        .groupBy("session_id")
        .agg(
            F.count(F.lit(1)).alias("conversion_count"),
            F.sum("booking_value").alias("total_booking_value"),
            F.sum("commission").alias("total_commission"),
        )
    )


def search_sessions(searches: DataFrame, clicks: DataFrame, conversions: DataFrame) -> DataFrame:
    """One row per session that has a search. Each side is aggregated before the
    join, so nothing fans out and no join sees more than one row per session.
    """
    clicked = F.coalesce("click_count", F.lit(0).cast("long"))
    converted = F.coalesce("conversion_count", F.lit(0).cast("long"))
    joined = (
        session_searches(searches)
        .join(session_clicks(clicks), "session_id", "left")
        .join(session_conversions(conversions), "session_id", "left")
        .withColumns({"click_count": clicked, "conversion_count": converted})
    )
    money = F.lit(0).cast("decimal(20,2)")
    return joined.select(
        "session_id",
        "user_id",
        "session_start",
        "session_end",
        minutes_between(F.col("session_end"), F.col("session_start")).alias(
            "session_duration_minutes"
        ),
        "search_count",
        "unique_queries",
        "click_count",
        F.coalesce("avg_click_position", F.lit(0.0)).alias("avg_click_position"),
        "conversion_count",
        F.coalesce("total_booking_value", money).alias("total_booking_value"),
        F.coalesce("total_commission", money).alias("total_commission"),
        *[F.col("_context")[c].alias(c) for c in CONTEXT],
        ratio(F.col("click_count"), F.col("search_count")).alias("session_ctr"),
        ratio(F.col("conversion_count"), F.col("click_count")).alias("session_conversion_rate"),
        F.when(F.col("conversion_count") > 0, "converted")
        .when(F.col("click_count") > 0, "engaged")
        .otherwise("bounced")
        .alias("session_outcome"),
    )

"""Search → click → conversion journeys and attribution of conversions to touches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripfunnel.functions.scalar import minutes_between
from tripfunnel.operators.rows import left_join_many
from tripfunnel.operators.timeline import carry_forward, running_count


def user_journeys(searches: DataFrame, clicks: DataFrame, conversions: DataFrame) -> DataFrame:
    """One row per search × click × conversion; searches without either stay.

    Clicks meet their conversions first. Joining searches to clicks first would give
    most rows a null click id, and all of those would land in one partition.
    """
    booked = conversions.filter(F.col("click_event_id").isNotNull()).select(
        F.col("click_event_id").alias("_booked_click"),
        F.col("event_id").alias("conversion_event_id"),
        F.col("event_timestamp").alias("conversion_timestamp"),
        "booking_value",
        "commission",
        F.col("product_type").alias("converted_product_type"),
    )
    touched = clicks.filter(F.col("search_event_id").isNotNull()).select(
        "search_event_id",
        "event_id",
        "event_timestamp",
        "result_position",
        "result_type",
        "result_price",
        "result_destination",
        "result_provider",
    )
    # Renaming after the join leaves both of its branches the same input to share.
    outcomes = left_join_many(touched, booked, "event_id", "_booked_click").withColumnsRenamed(
        {
            "search_event_id": "_clicked_search",
            "event_id": "click_event_id",
            "event_timestamp": "click_timestamp",
        }
    )
    searched = searches.select(
        "event_id",
        "event_timestamp",
        "user_id",
        "session_id",
        "search_query",
        "results_count",
        "platform",
        "device_type",
        "geo_country",
        "utm_source",
        "utm_campaign",
    )
    joined = left_join_many(
        searched,
        outcomes,
        "event_id",
        "_clicked_search",
        present=touched.withColumnRenamed("search_event_id", "_clicked_search"),
    ).withColumnsRenamed(
        {
            "event_id": "search_event_id",
            "event_timestamp": "search_timestamp",
            "results_count": "search_results_count",
        }
    )

    def minutes(later: str, earlier: str):
        return F.round(minutes_between(F.col(later), F.col(earlier)), 2)

    converted = F.col("conversion_event_id").isNotNull()
    money = F.lit(0).cast("decimal(10,2)")
    return joined.select(
        "search_event_id",
        "click_event_id",
        "conversion_event_id",
        "user_id",
        "session_id",
        "search_timestamp",
        "search_query",
        "search_results_count",
        "platform",
        "device_type",
        "geo_country",
        "utm_source",
        "utm_campaign",
        "click_timestamp",
        "result_position",
        "result_type",
        "result_price",
        "result_destination",
        "result_provider",
        "conversion_timestamp",
        "booking_value",
        "commission",
        "converted_product_type",
        minutes("click_timestamp", "search_timestamp").alias("search_to_click_minutes"),
        minutes("conversion_timestamp", "click_timestamp").alias("click_to_conversion_minutes"),
        minutes("conversion_timestamp", "search_timestamp").alias("search_to_conversion_minutes"),
        F.when(converted, "converted")
        .when(F.col("click_event_id").isNotNull(), "clicked")
        .otherwise("searched_only")
        .alias("journey_stage"),
        F.when(converted, 1).otherwise(0).alias("is_converted"),
        F.coalesce("booking_value", money).alias("attributed_revenue"),
        F.coalesce("commission", money).alias("attributed_commission"),
    )


def _timeline(conversions: DataFrame, touches: DataFrame, key: str, probe_at, touch_at) -> DataFrame:
    """Touches and probes of both sides on one clock; touches come first on a tie."""
    marks = touches.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"),
        touch_at.alias("_at"),
        F.lit(0).alias("_probe"),
        F.col("event_id").alias("_id"),
        F.struct(
            F.col("event_timestamp").alias("touch_timestamp"),
            F.col("event_id").alias("touch_event_id"),
        ).alias("_touch"),
    )
    probes = conversions.select(
        F.col(key).alias("_key"),
        probe_at.alias("_at"),
        F.lit(1).alias("_probe"),
        F.col("event_id").alias("_id"),
        F.struct(*conversions.columns).alias("_row"),
    )
    return marks.unionByName(probes, allowMissingColumns=True)


def _mirrored(moment):
    """Runs the clock backwards, which turns 'next touch' into 'previous touch'."""
    return F.timestamp_micros(-F.unix_micros(moment))


def attribute(
    conversions: DataFrame,
    touches: DataFrame,
    window_hours: float = 24,
    model: str = "last",
    key: str = "user_id",
    bucket_seconds: int = 300,
    burst_rows: int = 200_000,
) -> DataFrame:
    """Credits conversions with touches of the same user in the hours before.

    ``last`` and ``first`` add ``touch_event_id`` and ``touch_timestamp`` of the
    nearest and the earliest touch in ``[conversion - window, conversion]``; ``any``
    adds ``touch_count``. Among touches at the same instant the largest id counts. None
    of them builds conversion-touch pairs: a user with a third of all events costs as much
    per event as everybody else, also if all of them fall into one minute.
    """
    window = F.make_dt_interval(secs=F.lit(window_hours * 3600))
    converted_at = F.col("event_timestamp")
    if model == "any":
        return _attribute_any(conversions, touches, window, key, bucket_seconds, burst_rows)
    if model == "last":
        timeline = _timeline(conversions, touches, key, converted_at, converted_at)
        chosen = carry_forward(
            timeline, "_key", "_at", ["_probe", "_id"], {"_hit": F.col("_touch")}, bucket_seconds, burst_rows
        )
        inside = F.col("_hit.touch_timestamp") >= F.col("_row.event_timestamp") - window
    elif model == "first":
        timeline = _timeline(
            conversions, touches, key, _mirrored(converted_at - window), _mirrored(converted_at)
        )
        chosen = carry_forward(
            timeline, "_key", "_at", ["_probe", "_id"], {"_hit": F.col("_touch")}, bucket_seconds, burst_rows
        )
        inside = F.col("_hit.touch_timestamp") <= F.col("_row.event_timestamp")
    else:
        raise ValueError(f"unknown attribution model: {model}")
    return (
        chosen.filter(F.col("_probe") == 1)
        .withColumn("_hit", F.when(inside, F.col("_hit")))
        .select("_row.*", "_hit.touch_event_id", "_hit.touch_timestamp")
    )


def _attribute_any(conversions, touches, window, key, bucket_seconds, burst_rows) -> DataFrame:
    at_end = _timeline(conversions, touches, key, F.col("event_timestamp"), F.col("event_timestamp"))
    # Touches exactly at the start of the window count: this probe stands just before it.
    before_start = F.col("event_timestamp") - window - F.make_dt_interval(secs=F.lit(0.000001))
    at_start = conversions.select(
        F.col(key).alias("_key"),
        before_start.alias("_at"),
        F.lit(2).alias("_probe"),
        F.col("event_id").alias("_id"),
        F.struct(*conversions.columns).alias("_row"),
    )
    counted = running_count(
        at_end.unionByName(at_start, allowMissingColumns=True),
        "_key",
        "_at",
        ["_probe", "_id"],
        F.col("_touch").isNotNull(),
        "_seen",
        bucket_seconds,
        burst_rows,
    )
    signed = F.when(F.col("_probe") == 1, F.col("_seen")).otherwise(-F.col("_seen"))
    # Equal conversions see the same touches: they are added up together and given out one by one.
    copies = F.count_if(F.col("_probe") == 1)
    return (
        counted.filter(F.col("_probe") > 0)
        .groupBy("_row")
        .agg(F.coalesce(F.sum(signed), F.lit(0)).alias("_sum"), copies.alias("_copies"))
        .select("_row", F.expr("_sum div _copies").alias("touch_count"), F.explode(F.sequence(F.lit(1).cast("long"), "_copies")))
        .select("_row.*", "touch_count")
    )

"""Streaming staging, deduplication, windows, sessions, journeys and merges.

State is bounded by the watermark throughout: events older than ``late`` behind the
newest one are dropped and show up in ``numRowsDroppedByWatermark``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripfunnel.operators import staging

LATE = "24 hours"


def stream_staging(raw: DataFrame, kind: str) -> DataFrame:
    """The staging projection on a stream; deduplication is ``stream_dedupe``."""
    fields = staging.FIELDS[kind]
    return (
        staging.parse(raw, fields)
        .filter(F.size("_errors") == 0)
        .select("event_id", *[staging.typed_value(f).alias(f.name) for f in fields], "ingested_at")
    )


def stream_rejects(raw: DataFrame, kind: str) -> DataFrame:
    return staging.staging_rejects(raw, kind)


def stream_dedupe(
    events: DataFrame, key: str = "event_id", ts: str = "event_timestamp", late: str = LATE
) -> DataFrame:
    """First arrival per id; ids are remembered for the lateness allowed."""
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def stream_funnel(
    events: DataFrame, *dims: str, size: str = "1 hour", slide: str | None = None,
    ts: str = "event_timestamp", late: str = LATE,
) -> DataFrame:
    """Counts per event type and click rate in tumbling (or, with ``slide``, sliding)
    windows over one stream that holds all event types.
    """
    kind = F.col("event_type")
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    counted = (
        events.withWatermark(ts, late)
        .groupBy(window.alias("_window"), *dims)
        .agg(
            F.count_if(kind == "search").alias("searches"),
            F.count_if(kind == "click").alias("clicks"),
            F.count_if(kind == "conversion").alias("conversions"),
        )
    )
    rate = F.when(F.col("searches") > 0, F.col("clicks") / F.col("searches").cast("double"))
    return counted.select(
        F.col("_window.start").alias("window_start"),
        F.col("_window.end").alias("window_end"),
        *dims,
        "searches",
        "clicks",
        "conversions",
        rate.otherwise(F.lit(0.0)).alias("click_through_rate"),
    )


def stream_sessions(
    events: DataFrame, user: str = "user_id", timeout: str = "30 minutes",
    ts: str = "event_timestamp", late: str = LATE,
) -> DataFrame:
    """Gap sessions per known user. Spark's session window ends a session when the gap
    reaches the timeout, the batch operator when it exceeds it: the two differ on gaps
    of exactly the timeout.
    """
    kind = F.col("event_type")
    return (
        events.filter(F.col(user).isNotNull())
        .withWatermark(ts, late)
        .groupBy(F.session_window(ts, timeout).alias("_session"), user)
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.count_if(kind == "search").alias("search_count"),
            F.count_if(kind == "click").alias("click_count"),
            F.count_if(kind == "conversion").alias("conversion_count"),
        )
        .select(
            user,
            F.col("_session.start").alias("session_start"),
            F.col("_session.end").alias("session_end"),
            "events",
            "search_count",
            "click_count",
            "conversion_count",
        )
    )


def _within(later: str, earlier: str, window: str) -> Column:
    return (F.col(later) >= F.col(earlier)) & (
        F.col(later) <= F.col(earlier) + F.expr(f"INTERVAL {window}")
    )


def stream_journeys(
    searches: DataFrame, clicks: DataFrame, conversions: DataFrame, click_window: str = "24 hours",
    booking_window: str = "48 hours", late: str = LATE,
) -> DataFrame:
    """Search → click → conversion as two left outer stream-stream joins; both windows
    are counted from the search.

    Time bounds let the state expire; rows without a match appear once the watermark has
    passed their window. Searches without a click are left out of the second join's key
    by giving them their own id, so that they do not meet in one partition.
    """
    s = searches.withWatermark("event_timestamp", late).select(
        F.col("event_id").alias("search_event_id"),
        F.col("event_timestamp").alias("search_timestamp"),
        "user_id",
        "search_query",
    )
    c = clicks.withWatermark("event_timestamp", late).select(
        F.col("search_event_id").alias("_search"),
        F.col("event_id").alias("click_event_id"),
        F.col("event_timestamp").alias("click_timestamp"),
        "result_destination",
    )
    v = conversions.withWatermark("event_timestamp", late).select(
        F.col("click_event_id").alias("_click"),
        F.col("event_id").alias("conversion_event_id"),
        F.col("event_timestamp").alias("conversion_timestamp"),
        "booking_value",
    )
    clicked = s.join(
        c,
        (F.col("search_event_id") == F.col("_search"))
        & _within("click_timestamp", "search_timestamp", click_window),
        "left_outer",
    ).withColumns(
        {
            "_click_key": F.coalesce(
                "click_event_id", F.concat(F.lit("no click for "), F.col("search_event_id"))
            ),
            # From here on the search time alone is the event time.
            "click_timestamp": F.timestamp_micros(F.unix_micros("click_timestamp")),
        }
    )
    return (
        clicked.join(
            v,
            (F.col("_click_key") == F.col("_click"))
            & _within("conversion_timestamp", "search_timestamp", booking_window),
            "left_outer",
        )
        .select(
            "search_event_id",
            "click_event_id",
            "conversion_event_id",
            "user_id",
            "search_query",
            "search_timestamp",
            "click_timestamp",
            "conversion_timestamp",
            "result_destination",
            "booking_value",
            F.when(F.col("conversion_event_id").isNotNull(), "converted")
            .when(F.col("click_event_id").isNotNull(), "clicked")
            .otherwise("searched_only")
            .alias("journey_stage"),
        )
    )


def write_stream(
    df: DataFrame, path: str, checkpoint: str, every: str | None = None, mode: str = "append"
) -> StreamingQuery:
    """Parquet sink with exactly-once files. ``every`` sets the cadence (5 minutes
    suits ingest); without it, all available data is read once.
    """
    writer = df.writeStream.outputMode(mode).format("parquet").option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start(path)


def merge_stream(
    df: DataFrame, merge: Callable[[DataFrame, int], None], checkpoint: str,
    every: str | None = None, mode: str = "update",
) -> StreamingQuery:
    """Hands every micro-batch to ``merge(batch, batch_id)``, for snapshot upserts."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).foreachBatch(merge).start()


def dropped_by_watermark(query: StreamingQuery) -> int:
    """Late rows dropped so far by the stateful operators of a query."""
    return sum(
        state.get("numRowsDroppedByWatermark", 0)
        for progress in query.recentProgress
        for state in progress["stateOperators"]
    )

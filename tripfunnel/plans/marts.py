"""Analytics and marketing marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripfunnel.functions.scalar import clock, days_between, engagement_score, hours_before, ratio
from tripfunnel.operators.sessions import CONTEXT


def search_funnel(sessions: DataFrame, dims: Sequence[str] = CONTEXT) -> DataFrame:
    """Daily funnel per dimension set. Sessions are unique already, so they are counted
    without a distinct; revenue ratios divide doubles, not decimals.
    """
    outcome = F.col("session_outcome")
    totals = sessions.groupBy(F.to_date("session_start").alias("funnel_date"), *dims).agg(
        F.count("session_id").alias("total_sessions"),
        F.sum("search_count").alias("total_searches"),
        F.sum("click_count").alias("total_clicks"),
        F.sum("conversion_count").alias("total_conversions"),
        F.sum("total_booking_value").alias("total_revenue"),
        F.sum("total_commission").alias("total_commission"),
        F.avg("session_duration_minutes").alias("avg_session_duration_minutes"),
        F.avg("avg_click_position").alias("avg_click_position"),
        F.avg("unique_queries").alias("avg_queries_per_session"),
        F.count_if(outcome == "converted").alias("converted_sessions"),
        F.count_if(outcome == "engaged").alias("engaged_sessions"),
        F.count_if(outcome == "bounced").alias("bounced_sessions"),
    )
    searches, clicks = F.col("total_searches"), F.col("total_clicks")
    conversions, revenue = F.col("total_conversions"), F.col("total_revenue")
    return totals.select(
        "funnel_date",
        *dims,
        "total_sessions",
        "total_searches",
        "total_clicks",
        "total_conversions",
        "total_revenue",
        "total_commission",
        ratio(clicks, searches).alias("click_through_rate"),
        ratio(conversions, clicks).alias("conversion_rate"),
        ratio(conversions, searches).alias("search_to_conversion_rate"),
        "avg_session_duration_minutes",
        "avg_click_position",
        "avg_queries_per_session",
        ratio(revenue, conversions).alias("avg_order_value"),
        ratio(revenue, F.col("total_sessions")).alias("revenue_per_session"),
        "converted_sessions",
        "engaged_sessions",
        "bounced_sessions",
    )


def user_dimension(sessions: DataFrame, as_of=None, primary: str = "max") -> DataFrame:
    """Lifetime metrics per known user. ``primary="max"`` takes the largest context
    value, ``"mode"`` the most frequent one (smallest on a tie).
    """
    now = clock(as_of)
    known = sessions.filter(F.col("user_id").isNotNull())
    usual = F.max if primary == "max" else (lambda c: F.mode(c, True))
    metrics = known.groupBy("user_id").agg(
        F.min("session_start").alias("first_seen_at"),
        F.max("session_end").alias("last_seen_at"),
        F.count("session_id").alias("total_sessions"),
        F.sum("search_count").alias("lifetime_searches"),
        F.sum("click_count").alias("lifetime_clicks"),
        F.sum("conversion_count").alias("lifetime_conversions"),
        F.sum("total_booking_value").alias("lifetime_revenue"),
        F.sum("total_commission").alias("lifetime_commission"),
        usual("platform").alias("primary_platform"),
        usual("device_type").alias("primary_device"),
        usual("geo_country").alias("primary_country"),
        F.avg("session_duration_minutes").alias("avg_session_duration"),
        F.avg("session_ctr").alias("avg_ctr"),
        F.avg("session_conversion_rate").alias("avg_conversion_rate"),
    )
    revenue, conversions = F.col("lifetime_revenue"), F.col("lifetime_conversions")
    return metrics.select(
        "user_id",
        "first_seen_at",
        "last_seen_at",
        days_between(now, F.col("last_seen_at")).alias("days_since_last_seen"),
        days_between(now, F.col("first_seen_at")).alias("account_age_days"),
        "total_sessions",
        "lifetime_searches",
        "lifetime_clicks",
        "lifetime_conversions",
        "lifetime_revenue",
        "lifetime_commission",
        "primary_platform",
        "primary_device",
        "primary_country",
        "avg_session_duration",
        "avg_ctr",
        "avg_conversion_rate",
        ratio(F.col("lifetime_clicks"), F.col("lifetime_searches")).alias("lifetime_ctr"),
        ratio(conversions, F.col("lifetime_clicks")).alias("lifetime_conversion_rate"),
        ratio(revenue, F.col("total_sessions")).alias("revenue_per_session"),
        ratio(revenue, conversions).alias("avg_order_value"),
    )


def recent_users(events: DataFrame, as_of=None, hours: float = 48) -> DataFrame:
    """Known users with an event in the last ``hours``, each once."""
    return (
        events.filter(F.col("event_timestamp") >= hours_before(clock(as_of), hours))
        .filter(F.col("user_id").isNotNull())
        .select("user_id")
        .distinct()
    )


def user_segments(
    users: DataFrame, searches: DataFrame, conversions: DataFrame, as_of=None, hours: float = 48
) -> DataFrame:
    """Marketing segment and engagement score per user; the first matching rule wins."""
    searched = recent_users(searches, as_of, hours).withColumn("_searched", F.lit(True))
    converted = recent_users(conversions, as_of, hours).withColumn("_converted", F.lit(True))
    segment = (
        F.when((F.col("lifetime_revenue") > 500) | (F.col("lifetime_conversions") >= 5), "high_value")
        .when(F.col("account_age_days") <= 7, "new_user")
        .when((F.col("days_since_last_seen") > 30) & (F.col("lifetime_conversions") > 0), "at_risk")
        .when(F.col("_searched").isNotNull() & F.col("_converted").isNull(), "abandoned_search")
        .otherwise("regular")
    )
    return (
        users.join(searched, "user_id", "left")
        .join(converted, "user_id", "left")
        .select(
            "user_id",
            segment.alias("segment"),
            engagement_score(
                F.col("lifetime_conversions"),
                F.col("total_sessions"),
                F.col("avg_ctr"),
                F.col("days_since_last_seen"),
            ).alias("engagement_score"),
            "lifetime_revenue",
            "lifetime_conversions",
            "lifetime_searches",
            "first_seen_at",
            "last_seen_at",
            "days_since_last_seen",
            "account_age_days",
            "primary_platform",
            "primary_country",
            clock(as_of).alias("segmented_at"),
        )
    )

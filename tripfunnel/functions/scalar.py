"""Scalar column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# The destination catalogue, in match order.
DESTINATIONS = (
    "Miami", "Toronto", "NYC", "Los Angeles", "Las Vegas",
    "Cancun", "Vancouver", "Montreal", "Chicago", "Boston",
    "San Francisco", "Seattle", "Denver", "Orlando", "Hawaii",
)

MICROS_PER_SECOND = 1_000_000


def clock(as_of: datetime | str | Column | None) -> Column:
    """The pinned clock of an operator; ``None`` means now."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("timestamp")


def hours_before(moment: Column, hours: float) -> Column:
    return moment - F.make_dt_interval(secs=F.lit(hours * 3600))


def seconds_between(later: Column, earlier: Column) -> Column:
    """Fractional seconds; ``unix_timestamp`` would drop the fraction."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(float(MICROS_PER_SECOND))


def minutes_between(later: Column, earlier: Column) -> Column:
    return seconds_between(later, earlier) / F.lit(60.0)


def days_between(later: Column, earlier: Column) -> Column:
    return seconds_between(later, earlier) / F.lit(86400.0)


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` as double, 0 when there is nothing to divide by."""
    return F.when(denominator > 0, numerator.cast("double") / denominator).otherwise(F.lit(0.0))


def half_up(value: Column) -> Column:
    """Nearest whole number, halves upwards, as the dashboard rounds."""
    return F.floor(value + F.lit(0.5))


def clamp(value: Column, low, high) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def destination_of(query: Column, destinations: Sequence[str] = DESTINATIONS) -> Column:
    """First catalogue entry named in the query, ignoring case; null when none is."""
    text = F.lower(query)
    return F.coalesce(
        *[F.when(text.contains(name.lower()), F.lit(name)) for name in destinations]
    )


def product_type_of(query: Column) -> Column:
    """Product line named in the query; null when the words say nothing."""
    text = F.lower(query)
    return (
        F.when(text.contains("flight"), "flight")
        .when(text.contains("hotel") | text.contains("airbnb"), "hotel")
        .when(text.contains("car"), "car")
        .when(text.contains("package") | text.contains("vacation"), "package")
    )


def device_of(platform: Column, web_device: Column | None = None) -> Column:
    """Apps are mobile; a browser keeps its own device when that is known."""
    known = F.lit("desktop") if web_device is None else F.coalesce(web_device, F.lit("desktop"))
    return (
        F.when(platform.isin("ios", "android"), "mobile")
        .when(platform == "web", known)
        .otherwise("desktop")
    )


def risk_level(probability: Column) -> Column:
    return (
        F.when(probability < 0.3, "low").when(probability < 0.7, "medium").otherwise("high")
    )


def engagement_score(
    conversions: Column, sessions: Column, avg_ctr: Column, idle_days: Column
) -> Column:
    """0-100: bookings 30, sessions up to 30, click rate up to 20, recency up to 20."""
    booked = F.when(conversions > 0, 30).otherwise(0)
    visits = F.least(sessions, F.lit(10)) * 3
    clicks = F.when(avg_ctr > 0.3, 20).otherwise(F.rint(avg_ctr * 60).cast("int"))
    recency = (
        F.when(idle_days < 7, 20).when(idle_days < 14, 15).when(idle_days < 30, 10).otherwise(0)
    )
    return clamp(booked + visits + clicks + recency, 0, 100).cast("int")


def duration_text(seconds: Column) -> Column:
    """``42s``, ``3m 5s`` or ``2h 10m``."""
    whole = F.floor(seconds)
    minutes = F.floor(seconds / 60)
    return (
        F.when(seconds < 60, F.concat(half_up(seconds).cast("string"), F.lit("s")))
        .when(
            seconds < 3600,
            F.concat(minutes.cast("string"), F.lit("m "), (whole % 60).cast("string"), F.lit("s")),
        )
        .otherwise(
            F.concat(
                F.floor(seconds / 3600).cast("string"),
                F.lit("h "),
                F.floor((whole % 3600) / 60).cast("string"),
                F.lit("m"),
            )
        )
    )


def age_text(moment: Column, as_of: Column) -> Column:
    """``just now``, ``5m ago``, ``3h ago``, ``2d ago``, then the calendar day."""
    seconds = F.floor(seconds_between(as_of, moment))
    minutes, hours, days = (F.floor(seconds / n) for n in (60, 3600, 86400))
    return (
        F.when(seconds < 60, "just now")
        .when(minutes < 60, F.concat(minutes.cast("string"), F.lit("m ago")))
        .when(hours < 24, F.concat(hours.cast("string"), F.lit("h ago")))
        .when(days < 7, F.concat(days.cast("string"), F.lit("d ago")))
        .otherwise(F.date_format(moment, "MMM d"))
    )

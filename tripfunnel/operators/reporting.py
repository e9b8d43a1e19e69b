"""Reporting: time series, top lists, funnels, trends, cohorts, run statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripfunnel.functions.scalar import clock, half_up, ratio, seconds_between


def downsample(df: DataFrame, ts: str, value: str, buckets: int = 800, average: bool = True) -> DataFrame:
    """Thins a series to about ``buckets`` averages of equal time width; without
    ``average`` every point comes back as it is (count 1). Either holds at any length.

    The last point falls into a bucket of its own. Decimal values are averaged exactly.
    Only the two scalars that size the buckets are read on the driver; the series itself
    is aggregated in place.
    """
    millis = F.unix_micros(ts) / F.lit(1000.0)
    points = df.select(millis.alias("timestamp_ms"), F.col(value).alias("value"))
    points = points.filter(F.col("timestamp_ms").isNotNull())
    if not average:
        one = F.lit(1).cast("long")
        return points.select(
            "timestamp_ms", "value", one.alias("count"),
            F.col("value").alias("min_value"), F.col("value").alias("max_value"),
        )
    start, end = points.agg(F.min("timestamp_ms"), F.max("timestamp_ms")).first()
    width = (end - start) / buckets if start is not None else 0
    index = F.floor((F.col("timestamp_ms") - F.lit(start)) / F.lit(width)) if width else F.lit(0)
    return (
        points.groupBy(index.cast("long").alias("_index"))
        .agg(
            F.round(F.avg("value"), 2).alias("value"),
            F.count(F.lit(1)).alias("count"),
            F.min("value").alias("min_value"),
            F.max("value").alias("max_value"),
        )
        .select(
            (F.lit(start) + F.col("_index") * F.lit(width)).alias("timestamp_ms"),
            "value", "count", "min_value", "max_value",
        )
    )


def top_queries(journeys: DataFrame, n: int = 10) -> DataFrame:
    """Most searched queries with average clicked position and click rate.

    Journeys fan out per click, so they are first folded back to one row per search.
    """
    per_search = journeys.groupBy("search_query", "search_event_id").agg(
        F.sum("result_position").alias("_positions"),
        F.count("result_position").alias("_clicks"),
        F.max(F.col("click_event_id").isNotNull().cast("int")).alias("_clicked"),
    )
    return (
        per_search.groupBy(F.col("search_query").alias("query"))
        .agg(
            F.count(F.lit(1)).alias("count"),
            (F.sum("_positions").cast("double") / F.nullif(F.sum("_clicks"), F.lit(0))).alias(
                "avg_position"
            ),
            F.avg("_clicked").alias("click_rate"),
        )
        .orderBy(F.col("count").desc(), F.col("query").asc_nulls_last())
        .limit(n)
    )


def segment_distribution(segments: DataFrame) -> DataFrame:
    return segments.groupBy("segment").agg(F.count(F.lit(1)).alias("users"))


def segment_summary(segments: DataFrame) -> DataFrame:
    """Users, average searches and bookings per 100 searches for each segment."""
    return segments.groupBy("segment").agg(
        F.count(F.lit(1)).alias("user_count"),
        F.avg("lifetime_searches").alias("avg_searches"),
        (ratio(F.sum("lifetime_conversions"), F.sum("lifetime_searches")) * 100).alias(
            "conversion_rate"
        ),
    )


def _funnel_sums(prefix: str = "") -> list[Column]:
    return [
        F.coalesce(F.sum(f"total_{c}"), F.lit(0)).alias(f"{prefix}{c}")
        for c in ("searches", "clicks", "conversions")
    ]


def _funnel_rates(df: DataFrame) -> DataFrame:
    """Click and conversion rate in percent, both per search."""
    return df.withColumns(
        {
            "click_through_rate": ratio(F.col("clicks"), F.col("searches")) * 100,
            "conversion_rate": ratio(F.col("conversions"), F.col("searches")) * 100,
        }
    )


def daily_funnel(funnel: DataFrame, days: int | None = 7, as_of=None) -> DataFrame:
    """Searches, clicks, conversions and rates per day, for the last ``days`` days."""
    if days is not None:
        funnel = funnel.filter(F.col("funnel_date") > F.date_sub(F.to_date(clock(as_of)), days))
    return _funnel_rates(funnel.groupBy(F.col("funnel_date").alias("date")).agg(*_funnel_sums()))


def funnel_totals(funnel: DataFrame) -> DataFrame:
    return _funnel_rates(funnel.agg(*_funnel_sums()))


def revenue_at_risk(funnel: DataFrame, rate: float = 0.08, avg_value: float = 450.0) -> DataFrame:
    """Bookings missing from an expected rate, valued at an average booking."""
    lost = F.greatest(
        F.lit(0), half_up(F.col("searches") * F.lit(rate)) - F.col("conversions")
    ).cast("long")
    return (
        funnel.agg(*_funnel_sums())
        .withColumn("lost_bookings", lost)
        .withColumn("revenue_at_risk", F.col("lost_bookings") * F.lit(float(avg_value)))
    )


FUNNEL_STEPS = ("searches", "clicks", "conversions")


def funnel_steps(funnel: DataFrame, dims: Sequence[str] = ()) -> DataFrame:
    """One row per step with the rate to the step before and the width against the
    widest step, both in percent; the first step has rate 100.
    """
    sums = funnel.groupBy(*dims).agg(*_funnel_sums()) if dims else funnel.agg(*_funnel_sums())
    steps = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("step"),
                F.lit(name).alias("name"),
                F.col(name).cast("long").alias("value"),
                F.col(FUNNEL_STEPS[max(i - 1, 0)]).cast("long").alias("_previous"),
                F.greatest(*FUNNEL_STEPS).alias("_widest"),
            )
            for i, name in enumerate(FUNNEL_STEPS)
        ]
    )
    return sums.select(*dims, F.inline(steps)).select(
        *dims,
        "step",
        "name",
        "value",
        F.when(F.col("step") == 1, F.lit(100.0))
        .otherwise(F.try_divide(F.col("value") * 100.0, F.col("_previous")))
        .alias("conversion_rate"),
        F.try_divide(F.col("value") * 100.0, F.col("_widest")).alias("width_percent"),
        (F.col("_previous") - F.col("value")).alias("lost"),
    )


def funnel_dropoff(funnel: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Step losses per dimension value, for example platform, device or country."""
    return funnel_steps(funnel, dims)


def funnel_rollup(funnel: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Funnel totals per dimension prefix, down to the grand total; ``level`` counts the
    dimensions rolled away.
    """
    rolled = funnel.rollup(*dims).agg(*_funnel_sums(), F.grouping_id().alias("_gid"))
    level = F.bit_count("_gid").cast("int")
    return _funnel_rates(rolled.withColumn("level", level).drop("_gid"))


def channel_performance(funnel: DataFrame) -> DataFrame:
    """Volumes, revenue and rates per traffic source and campaign."""
    sums = funnel.groupBy("utm_source", "utm_campaign").agg(
        F.sum("total_sessions").alias("sessions"),
        *_funnel_sums(),
        F.sum("total_revenue").alias("revenue"),
        F.sum("total_commission").alias("commission"),
    )
    return _funnel_rates(sums).withColumns(
        {
            "revenue_per_session": ratio(F.col("revenue"), F.col("sessions")),
            "avg_order_value": ratio(F.col("revenue"), F.col("conversions")),
        }
    )


def kpi_by_period(
    funnel: DataFrame, grain: str = "month", date: str = "funnel_date",
    measures: Sequence[str] = ("total_searches", "total_clicks", "total_conversions", "total_revenue"),
) -> DataFrame:
    """Sums per day, week, month or year with the same period a year earlier.

    A week is compared with the week 52 weeks before. The comparison joins two small
    per-period tables.
    """
    periods = funnel.groupBy(F.to_date(F.date_trunc(grain, date)).alias("period")).agg(
        *[F.sum(m).alias(m) for m in measures]
    )
    year_later = (
        F.date_add("period", 364) if grain == "week" else F.add_months("period", 12)
    )
    # 28 and 29 February both lead to 28 February: only a true anniversary counts.
    anniversary = (
        F.lit(True) if grain == "week" else F.add_months(year_later, -12) == F.col("period")
    )
    before = periods.filter(anniversary).select(
        year_later.alias("period"), *[F.col(m).alias(f"{m}_last_year") for m in measures]
    )
    joined = periods.join(before, "period", "left")
    return joined.withColumns(
        {
            f"{m}_yoy": F.when(
                F.col(f"{m}_last_year") != 0,
                F.col(m).cast("double") / F.col(f"{m}_last_year").cast("double") - 1,
            )
            for m in measures
        }
    )


def cohort_retention(sessions: DataFrame, grain: str = "week") -> DataFrame:
    """Users by first period × periods since, with the share of the cohort still active.

    Users are reduced to one row per active period before anything is counted.
    """
    active = (
        sessions.filter(F.col("user_id").isNotNull())
        .select("user_id", F.to_date(F.date_trunc(grain, "session_start")).alias("period"))
        .distinct()
    )
    # The first period needs no raw rows again: a user has few distinct periods.
    by_user = Window.partitionBy("user_id")
    cohorts = active.withColumn("cohort", F.min("period").over(by_user))
    days = {"day": 1, "week": 7}
    if grain in days:
        offset = F.floor(F.date_diff("period", "cohort") / days[grain])
    else:
        months = {"month": 1, "quarter": 3, "year": 12}[grain]
        offset = F.floor(F.round(F.months_between("period", "cohort")) / months)
    counted = cohorts.groupBy("cohort", offset.cast("int").alias("periods_since")).agg(
        F.count(F.lit(1)).alias("users")
    )
    size = F.max(F.when(F.col("periods_since") == 0, F.col("users"))).over(
        Window.partitionBy("cohort")
    )
    return counted.withColumn("retention", F.col("users").cast("double") / size)


def record_counts(models: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per named table; each count is its own distributed aggregate."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("count")).select(F.lit(name).alias("table"), "count")
        for name, df in models.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def record_count_trend(history: DataFrame) -> DataFrame:
    """Change of each table's count against its previous snapshot."""
    previous = F.lag("count").over(Window.partitionBy("table").orderBy("updated_at"))
    return history.withColumn("previous_count", F.coalesce(previous, F.lit(0))).withColumns(
        {
            "delta": F.col("count") - F.col("previous_count"),
            "delta_percent": F.when(
                F.col("previous_count") > 0,
                (F.col("count") - F.col("previous_count")) * 100.0 / F.col("previous_count"),
            ).otherwise(F.lit(0.0)),
        }
    )


def run_metrics(log: DataFrame) -> DataFrame:
    """Totals, failures, average duration, last run and health over a run log."""
    success = F.count_if(F.col("status") == "success")
    return log.agg(
        F.count(F.lit(1)).alias("total_runs"),
        success.alias("successful_runs"),
        F.count_if(F.col("status") == "failed").alias("failed_runs"),
        F.avg(seconds_between(F.col("completed_at"), F.col("started_at"))).alias("average_duration"),
        F.max("started_at").alias("last_run_time"),
        (ratio(success, F.count(F.lit(1))) * 100).alias("health_percent"),
    )


def filter_runs(
    log: DataFrame, start=None, end=None, ids: Sequence[str] = (), status: Sequence[str] = ()
) -> DataFrame:
    """Runs in a time range, of some jobs, with some statuses; empty means all."""
    if start is not None:
        log = log.filter(F.col("started_at") >= F.lit(str(start)).cast("timestamp"))
    if end is not None:
        log = log.filter(F.col("started_at") <= F.lit(str(end)).cast("timestamp"))
    if ids:
        log = log.filter(F.col("dag_id").isin(*ids))
    if status:
        log = log.filter(F.col("status").isin(*status))
    return log


def recent_runs(log: DataFrame, n: int = 10) -> DataFrame:
    return log.orderBy(F.col("started_at").desc(), "run_id").limit(n)


def latest_days(funnel: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` most recent funnel rows, as a quick look at a fresh table."""
    keys = [f.name for f in funnel.schema.fields if f.name != "funnel_date" and f.dataType.typeName() == "string"]
    return funnel.orderBy(
        F.col("funnel_date").desc(), *[F.col(c).asc_nulls_last() for c in keys]
    ).limit(n)


def load_stats(points: DataFrame, kind: str = "type", value: str = "value") -> DataFrame:
    """Event count, error share in percent and mean value of a load."""
    return points.agg(
        F.count(F.lit(1)).alias("total_events"),
        (ratio(F.count_if(F.col(kind) == "error"), F.count(F.lit(1))) * 100).alias("error_rate"),
        F.avg(value).alias("avg_value"),
    )


def segment_transitions(snapshots: DataFrame, at: str = "segmented_at") -> DataFrame:
    """Moves between segments from one snapshot to the next: from, to, when, how many."""
    before = F.lag("segment").over(Window.partitionBy("user_id").orderBy(at))
    return (
        snapshots.withColumn("from_segment", before)
        .filter(F.col("from_segment").isNotNull() & (F.col("from_segment") != F.col("segment")))
        .groupBy("from_segment", F.col("segment").alias("to_segment"), F.col(at).alias("changed_at"))
        .agg(F.count(F.lit(1)).alias("users"))
    )

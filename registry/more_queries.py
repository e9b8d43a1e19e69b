"""Registered queries on reporting, text rules, ranking metrics, models and streams."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registry import inputs, sql
from registry.queries import (
    ALL_MODELS,
    AS_OF,
    EARLIER,
    EV,
    FUNNEL,
    FUNNEL_COLUMNS,
    RUN_COLUMNS,
    RUN_LOG,
    SEARCH_COLUMNS,
    SEGMENTS,
    SESSIONS,
    _affinity,
    _funnel,
    _journeys,
    _quality_models,
    _recommendations,
    _run_log,
    _segments,
    _sessions,
    _users,
    activation,
    churn,
    evaluation,
    read_table,
    recommender,
    register,
    reporting,
    ranking,
    rows,
    scalar,
    select,
    sentiment,
    splits,
)
from tripfunnel.plans import flow
from tripfunnel.session import scratch_path
from tripfunnel.sources.catalog import Catalog
from tripfunnel.sources.streams import stream_events
from tripfunnel.streaming import events as streaming
from tripfunnel.streaming import late
from tripfunnel.streaming.snapshots import Snapshot

# ---------------------------------------------------------------- reporting

MILLIS = "epoch_us(ts) / 1000.0::DOUBLE"


@register(
    "downsample",
    f"""WITH p AS (SELECT {MILLIS} AS t, CAST(value AS DECIMAL(10,2)) AS value FROM events),
    b AS (SELECT min(t) AS t0, (max(t) - min(t)) / 800 AS width FROM p),
    cut AS (SELECT CAST(floor((t - t0) / width) AS BIGINT) AS i, t0, width, value FROM p, b)
    SELECT CAST(floor(t0 + i * width) AS BIGINT) AS timestamp_ms, round(CAST((2 * CAST(sum(value) * 100 AS BIGINT) + count(*)) // (2 * count(*)) AS DOUBLE) / 100, 6) AS value,
      count(*) AS count, round(min(value), 6) AS min_value, round(max(value), 6) AS max_value
    FROM cut GROUP BY i, t0, width""",
)
def downsample(spark, sf_dir):
    events = read_table(spark, sf_dir, "events")
    points = events.select("ts", F.col("value").cast("decimal(10,2)").alias("value"))
    series = reporting.downsample(points, "ts", "value", 800)
    return series.withColumn("timestamp_ms", F.floor("timestamp_ms"))


@register(
    "top_queries",
    sql.query(
        EV, sql.JOURNEYS,
        final="""SELECT search_query AS query, count(DISTINCT search_event_id) AS count,
        round(avg(result_position), 6) AS avg_position,
        round(count(DISTINCT CASE WHEN click_event_id IS NOT NULL THEN search_event_id END)::DOUBLE
              / count(DISTINCT search_event_id), 6) AS click_rate
        FROM journeys GROUP BY search_query ORDER BY count DESC, query LIMIT 8""",
    ),
)
def top_queries(spark, sf_dir):
    return reporting.top_queries(_journeys(spark, sf_dir), 8)


@register(
    "segment_summary",
    sql.query(
        *SEGMENTS,
        final="""SELECT segment, count(*) AS user_count, round(avg(lifetime_searches), 6) AS avg_searches,
        round(sum(lifetime_conversions)::DOUBLE / sum(lifetime_searches)::DOUBLE * 100, 6) AS conversion_rate
        FROM segments GROUP BY segment""",
    ),
)
def segment_summary(spark, sf_dir):
    return reporting.segment_summary(_segments(spark, sf_dir))


_SUMS = ", ".join(
    f"CAST(coalesce(sum(total_{c}), 0) AS BIGINT) AS {c}" for c in ("searches", "clicks", "conversions")
)
_RATES = ", ".join(
    f"round({sql.over(n, 'searches')} * 100, 6) AS {name}"
    for n, name in (("clicks", "click_through_rate"), ("conversions", "conversion_rate"))
)


@register(
    "daily_funnel",
    sql.query(
        *FUNNEL,
        final=f"""SELECT *, {_RATES} FROM (SELECT strftime(funnel_date, '%Y-%m-%d') AS date, {_SUMS}
        FROM funnel WHERE funnel_date > DATE '2024-01-24' GROUP BY funnel_date)""",
    ),
)
def daily_funnel(spark, sf_dir):
    return reporting.daily_funnel(_funnel(spark, sf_dir), 7, AS_OF)


@register("funnel_totals", sql.query(*FUNNEL, final=f"SELECT *, {_RATES} FROM (SELECT {_SUMS} FROM funnel)"))
def funnel_totals(spark, sf_dir):
    return reporting.funnel_totals(_funnel(spark, sf_dir))


@register(
    "revenue_at_risk",
    sql.query(
        *FUNNEL,
        final=f"""SELECT *, lost_bookings * 450.0::DOUBLE AS revenue_at_risk FROM (
        SELECT *, CAST(greatest(0, floor(searches * 0.8::DOUBLE + 0.5) - conversions) AS BIGINT) AS lost_bookings
        FROM (SELECT {_SUMS} FROM funnel))""",
    ),
)
def revenue_at_risk(spark, sf_dir):
    """The events book far above the default rate, so a rate of 80 % is expected here."""
    return reporting.revenue_at_risk(_funnel(spark, sf_dir), rate=0.8)


def _steps_sql(dims: str = "") -> str:
    by, lead = (f"GROUP BY {dims}", f"{dims}, ") if dims else ("", "")
    return f"""SELECT {lead}step, name, value,
      round(CASE WHEN step = 1 THEN 100.0::DOUBLE WHEN previous > 0 THEN value * 100.0::DOUBLE / previous END, 6)
        AS conversion_rate,
      round(CASE WHEN widest > 0 THEN value * 100.0::DOUBLE / widest END, 6) AS width_percent,
      previous - value AS lost
    FROM (
      SELECT {lead}1 AS step, 'searches' AS name, searches AS value, searches AS previous, greatest(searches, clicks, conversions) AS widest FROM sums
      UNION ALL SELECT {lead}2, 'clicks', clicks, searches, greatest(searches, clicks, conversions) FROM sums
      UNION ALL SELECT {lead}3, 'conversions', conversions, clicks, greatest(searches, clicks, conversions) FROM sums)"""


@register("funnel_steps", sql.query(*FUNNEL, f"sums AS (SELECT {_SUMS} FROM funnel)", final=_steps_sql()))
def funnel_steps(spark, sf_dir):
    return reporting.funnel_steps(_funnel(spark, sf_dir))


_DIMS = "platform, device_type, geo_country"


@register(
    "funnel_dropoff",
    sql.query(*FUNNEL, f"sums AS (SELECT {_DIMS}, {_SUMS} FROM funnel GROUP BY {_DIMS})", final=_steps_sql(_DIMS)),
)
def funnel_dropoff(spark, sf_dir):
    return reporting.funnel_dropoff(_funnel(spark, sf_dir), ["platform", "device_type", "geo_country"])


@register(
    "funnel_rollup",
    sql.query(
        *FUNNEL,
        final=f"""SELECT *, {_RATES} FROM (SELECT platform, device_type, {_SUMS},
        CAST(grouping(platform) + grouping(device_type) AS INTEGER) AS level
        FROM funnel GROUP BY ROLLUP (platform, device_type))""",
    ),
)
def funnel_rollup(spark, sf_dir):
    return reporting.funnel_rollup(_funnel(spark, sf_dir), ["platform", "device_type"])


@register(
    "channel_performance",
    sql.query(
        *FUNNEL,
        final=f"""SELECT *, {_RATES}, round({sql.over('revenue', 'sessions')}, 6) AS revenue_per_session,
        round({sql.over('revenue', 'conversions')}, 6) AS avg_order_value FROM (
        SELECT utm_source, utm_campaign, CAST(sum(total_sessions) AS BIGINT) AS sessions, {_SUMS},
          round(CAST(sum(total_revenue) AS DOUBLE), 6) AS revenue,
          round(CAST(sum(total_commission) AS DOUBLE), 6) AS commission
        FROM funnel GROUP BY utm_source, utm_campaign)""",
    ),
)
def channel_performance(spark, sf_dir):
    return reporting.channel_performance(_funnel(spark, sf_dir))


def _kpi_sql(grain: str, source: str, date: str, measures: dict[str, str]) -> str:
    sums = ", ".join(f"{e} AS {m}" for m, e in measures.items())
    year = "INTERVAL 364 DAY" if grain == "week" else "INTERVAL 1 YEAR"
    same = "" if grain == "week" else "AND strftime(b.period, '%m-%d') = strftime(a.period, '%m-%d')"
    out = ", ".join(
        f"round(a.{m}::DOUBLE, 6) AS {m}, round(b.{m}::DOUBLE, 6) AS {m}_last_year, "
        f"round(CASE WHEN b.{m} <> 0 THEN a.{m}::DOUBLE / b.{m}::DOUBLE - 1 END, 6) AS {m}_yoy"
        for m in measures
    )
    return f"""periods AS (SELECT CAST(date_trunc('{grain}', {date}) AS DATE) AS period, {sums}
      FROM {source} GROUP BY 1)
    SELECT strftime(a.period, '%Y-%m-%d') AS period, {out} FROM periods a
    LEFT JOIN periods b ON CAST(b.period + {year} AS DATE) = a.period {same}"""


def _register_kpi(grain: str) -> None:
    measures = ("total_searches", "total_clicks", "total_conversions", "total_revenue")
    body = _kpi_sql(grain, "funnel", "funnel_date", {m: f"sum({m})" for m in measures})

    @register(f"kpi_by_{grain}", f"WITH {','.join(FUNNEL)}, {body}")
    def kpi(spark, sf_dir):
        return _as_doubles(reporting.kpi_by_period(_funnel(spark, sf_dir), grain), measures)

    money = {"revenue": "sum(o_totalprice::DECIMAL(12,2))"}

    @register(f"kpi_orders_{grain}", f"WITH {_kpi_sql(grain, 'orders', 'o_orderdate', money)}")
    def kpi_orders(spark, sf_dir):
        """Seven years of orders, so the year-over-year columns are filled."""
        orders = read_table(spark, sf_dir, "orders").select(
            "o_orderdate", F.col("o_totalprice").cast("decimal(12,2)").alias("revenue")
        )
        return reporting.kpi_by_period(orders, grain, "o_orderdate", ["revenue"])


def _as_doubles(df: DataFrame, measures) -> DataFrame:
    names = [f"{m}{suffix}" for m in measures for suffix in ("", "_last_year")]
    return df.withColumns({n: F.col(n).cast("double") for n in names})


for _grain in ("day", "week", "month"):
    _register_kpi(_grain)


@register(
    "cohort_retention",
    sql.query(
        *SESSIONS,
        """active AS (SELECT DISTINCT user_id, CAST(date_trunc('week', session_start) AS DATE) AS period
           FROM sessions WHERE user_id IS NOT NULL)""",
        """cohorts AS (SELECT *, min(period) OVER (PARTITION BY user_id) AS cohort FROM active)""",
        """counted AS (SELECT cohort, CAST((period - cohort) // 7 AS INTEGER) AS periods_since,
           count(*) AS users FROM cohorts GROUP BY ALL)""",
        final="""SELECT strftime(cohort, '%Y-%m-%d') AS cohort, periods_since, users,
        round(users::DOUBLE / max(CASE WHEN periods_since = 0 THEN users END) OVER (PARTITION BY cohort), 6)
          AS retention FROM counted""",
    ),
)
def cohort_retention(spark, sf_dir):
    return reporting.cohort_retention(_sessions(spark, sf_dir), "week")


_COUNTED = {
    "raw_search_events": "searches",
    "raw_click_events": "clicks",
    "raw_conversion_events": "conversions",
    "stg_search_events": "searches",
    "stg_click_events": "clicks",
    "stg_conversion_events": "conversions",
    "int_search_sessions": "sessions",
    "int_user_journeys": "journeys",
    "fct_search_funnel": "funnel",
    "dim_users": "users",
    "mart_user_segments": "segments",
    "mart_recommendations": "recommendations",
}


@register(
    "record_counts",
    sql.query(
        *ALL_MODELS,
        final=" UNION ALL ".join(
            f"""SELECT '{name}' AS "table", count(*) AS count FROM {cte}""" for name, cte in _COUNTED.items()
        ),
    ),
)
def record_counts(spark, sf_dir):
    models = _quality_models(spark, sf_dir)
    return reporting.record_counts({name: models[name]() for name in _COUNTED})


@register("catalog_tables", sql.query(*FUNNEL, final=select(FUNNEL_COLUMNS, "funnel")))
def catalog_tables(spark, sf_dir):
    """A model stored, read back and published as a view through logical names."""
    catalog = Catalog(spark, scratch_path(spark, "warehouse"))
    stored = catalog.materialize(_funnel(spark, sf_dir), "analytics.fct_search_funnel")
    catalog.register_view(stored, "reports.funnel")
    return spark.table("reports_funnel")


HISTORY = """
history AS (
  SELECT event_type AS "table", CAST(ts AS DATE) AS updated_at,
    CAST(sum(count(*)) OVER (PARTITION BY event_type ORDER BY CAST(ts AS DATE)) AS BIGINT) AS count
  FROM events GROUP BY event_type, CAST(ts AS DATE))"""


@register(
    "record_count_trend",
    f"""WITH {HISTORY}, p AS (SELECT *, coalesce(lag(count) OVER (PARTITION BY "table" ORDER BY updated_at), 0)
      AS previous_count FROM history)
    SELECT "table", strftime(updated_at, '%Y-%m-%d') AS updated_at, count, previous_count,
      count - previous_count AS delta,
      round(CASE WHEN previous_count > 0 THEN (count - previous_count) * 100.0::DOUBLE / previous_count
            ELSE 0 END, 6) AS delta_percent FROM p""",
)
def record_count_trend(spark, sf_dir):
    """Daily snapshots of the running event count per type."""
    from pyspark.sql import Window

    daily = (
        read_table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("table"), F.to_date("ts").alias("updated_at"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    running = Window.partitionBy("table").orderBy("updated_at")
    history = daily.select("table", "updated_at", F.sum("_n").over(running).alias("count"))
    return reporting.record_count_trend(history)


@register(
    "run_metrics",
    f"""WITH {RUN_LOG} SELECT count(*) AS total_runs,
    count(*) FILTER (WHERE status = 'success') AS successful_runs,
    count(*) FILTER (WHERE status = 'failed') AS failed_runs,
    round(avg((epoch_us(completed_at) - epoch_us(started_at)) / 1000000.0::DOUBLE), 6) AS average_duration,
    strftime(max(started_at), '%Y-%m-%d %H:%M:%S.%f') AS last_run_time,
    round(count(*) FILTER (WHERE status = 'success') * 100.0::DOUBLE / count(*), 6) AS health_percent FROM runs""",
)
def run_metrics(spark, sf_dir):
    return reporting.run_metrics(_run_log(spark, sf_dir))


@register(
    "filter_runs",
    f"""WITH {RUN_LOG} {select(RUN_COLUMNS, "runs WHERE started_at >= TIMESTAMP '2024-01-10 00:00:00' AND started_at <= TIMESTAMP '2024-01-20 00:00:00' AND dag_id IN ('view', 'click', 'error') AND status IN ('success', 'failed')")}""",
)
def filter_runs(spark, sf_dir):
    return reporting.filter_runs(
        _run_log(spark, sf_dir), "2024-01-10 00:00:00", "2024-01-20 00:00:00",
        ["view", "click", "error"], ["success", "failed"],
    )


@register(
    "recent_runs",
    f"WITH {RUN_LOG} {select(RUN_COLUMNS, 'runs')} ORDER BY runs.started_at DESC, run_id LIMIT 10",
)
def recent_runs(spark, sf_dir):
    return reporting.recent_runs(_run_log(spark, sf_dir), 10)


@register(
    "log_run",
    f"WITH {RUN_LOG} SELECT 'events' AS dag_id, 'success' AS status, count(*) AS runs, "
    "CAST(sum(rows_processed) AS BIGINT) AS rows_processed FROM runs",
)
def log_run(spark, sf_dir):
    """The whole run log appended to a stored log, plus one run logged on its own."""
    path = scratch_path(spark, "log")
    runs = _run_log(spark, sf_dir).withColumn("run_type", F.lit("ingest"))
    runs.withColumn("error_message", F.lit(None).cast("string")).write.parquet(path)
    total = runs.agg(F.count(F.lit(1)).alias("n"), F.sum("rows_processed").alias("r")).first()
    activation.log_run(
        spark, {"run_id": f"all-{total['n']}", "dag_id": "events", "status": "success",
                "rows_processed": total["r"]}, path,
    )
    log = spark.read.schema(activation.RUN_LOG_SCHEMA).parquet(path)
    logged = log.filter(F.col("dag_id") == "events")
    return logged.select(
        "dag_id", "status", (log.agg(F.count(F.lit(1)) - 1).scalar()).alias("runs"), "rows_processed"
    )


_FUNNEL_ORDER = "funnel_date DESC, platform, device_type, geo_country, utm_source NULLS LAST, utm_campaign NULLS LAST"


@register(
    "latest_days",
    sql.query(*FUNNEL, final=select(FUNNEL_COLUMNS, f"(SELECT * FROM funnel ORDER BY {_FUNNEL_ORDER} LIMIT 5)")),
)
def latest_days(spark, sf_dir):
    return reporting.latest_days(_funnel(spark, sf_dir), 5)


@register(
    "load_stats",
    """SELECT count(*) AS total_events,
    round(count(*) FILTER (WHERE event_type = 'error') * 100.0::DOUBLE / count(*), 6) AS error_rate,
    round(avg(value), 6) AS avg_value FROM events""",
)
def load_stats(spark, sf_dir):
    return reporting.load_stats(read_table(spark, sf_dir, "events"), "event_type", "value")


@register(
    "segment_transitions",
    sql.query(
        EV,
        sql.sessions("sessions_old", EARLIER),
        sql.users("users_old", "sessions_old", EARLIER),
        sql.segments("old", "users_old", EARLIER, EARLIER),
        sql.sessions(),
        sql.users(),
        sql.segments("new"),
        final=f"""SELECT o.segment AS from_segment, n.segment AS to_segment, '{AS_OF}.000000' AS changed_at,
        count(*) AS users FROM old o JOIN new n USING (user_id) WHERE o.segment <> n.segment GROUP BY ALL""",
    ),
)
def segment_transitions(spark, sf_dir):
    snapshots = _segments(spark, sf_dir, EARLIER).unionByName(_segments(spark, sf_dir))
    return reporting.segment_transitions(snapshots)


@register(
    "search_text",
    sql.query(EV, final="SELECT event_id, search_query FROM searches WHERE contains(search_query, 'dest_1')"),
)
def search_text(spark, sf_dir):
    searches = inputs.staged(spark, sf_dir, "search")
    return rows.search_text(searches, "search_query", "DEST_1").select("event_id", "search_query")


@register(
    "recent_events",
    sql.query(
        EV, final=select(SEARCH_COLUMNS, f"searches WHERE event_timestamp >= {sql.ts(AS_OF)} - INTERVAL 48 HOUR")
    ),
)
def recent_events(spark, sf_dir):
    searches = inputs.staged(spark, sf_dir, "search")
    return rows.recent(searches, "event_timestamp", 48, scalar.clock(AS_OF))


# ---------------------------------------------------------------- text rules

_KEYWORDS = """CASE WHEN contains(t, 'flight') THEN 'flight'
  WHEN contains(t, 'hotel') OR contains(t, 'airbnb') THEN 'hotel' WHEN contains(t, 'car') THEN 'car'
  WHEN contains(t, 'package') OR contains(t, 'vacation') THEN 'package' END"""
_REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


@register(
    "product_type_of",
    f"SELECT doc_id, {_KEYWORDS} AS product_type FROM (SELECT doc_id, lower(text) AS t FROM documents)",
)
def product_type_of(spark, sf_dir):
    documents = read_table(spark, sf_dir, "documents")
    return documents.select("doc_id", scalar.product_type_of(F.col("text")).alias("product_type"))


@register(
    "destination_of",
    "SELECT item_id, CASE "
    + " ".join(f"WHEN contains(lower(text), '{w}') THEN '{w.title()}'" for w in ("the", "and", "heo"))
    + " END AS destination FROM benchmark",
)
def destination_of(spark, sf_dir):
    """The first-match rule with a catalogue of words that the texts do contain."""
    texts = read_table(spark, sf_dir, "benchmark")
    return texts.select(
        "item_id", scalar.destination_of(F.col("text"), ("The", "And", "Heo")).alias("destination")
    )


@register(
    "device_of",
    sql.query(
        EV,
        final="""SELECT event_id, CASE WHEN platform IN ('ios', 'android') THEN 'mobile'
        ELSE device_type END AS device FROM searches""",
    ),
)
def device_of(spark, sf_dir):
    searches = inputs.staged(spark, sf_dir, "search")
    return searches.select(
        "event_id", scalar.device_of(F.col("platform"), F.col("device_type")).alias("device")
    )


@register(
    "display_texts",
    f"""SELECT event_id,
    CASE WHEN value < 60 THEN CAST(floor(value + 0.5) AS BIGINT) || 's'
         WHEN value < 3600 THEN CAST(floor(value / 60) AS BIGINT) || 'm ' || (CAST(floor(value) AS BIGINT) % 60) || 's'
         ELSE CAST(floor(value / 3600) AS BIGINT) || 'h ' || ((CAST(floor(value) AS BIGINT) % 3600) // 60) || 'm'
    END AS duration,
    CASE WHEN secs < 60 THEN 'just now' WHEN secs < 3600 THEN (secs // 60) || 'm ago'
         WHEN secs < 86400 THEN (secs // 3600) || 'h ago' WHEN secs < 604800 THEN (secs // 86400) || 'd ago'
         ELSE strftime(ts, '%b %-d') END AS age
    FROM (SELECT event_id, ts, value * 10 AS value,
          (epoch_us({sql.ts('2024-01-31 00:00:00')}) - epoch_us(ts)) // 1000000 AS secs FROM events)""",
)
def display_texts(spark, sf_dir):
    events = read_table(spark, sf_dir, "events")
    return events.select(
        "event_id",
        scalar.duration_text(F.col("value") * 10).alias("duration"),
        scalar.age_text(F.col("ts"), scalar.clock(AS_OF)).alias("age"),
    )


# ---------------------------------------------------------------- ranking metrics


def _measures(spark, sf_dir) -> DataFrame:
    """Per known user: the recommended destinations against those of all searches, one
    occurrence per search.
    """
    predicted = _recommendations(spark, sf_dir).withColumnRenamed("recommended_destination", "item")
    actual = (
        inputs.staged(spark, sf_dir, "search")
        .filter(F.col("user_id").isNotNull())
        .select("user_id", F.regexp_extract("search_query", "(dest_[0-9]+)", 1).alias("item"))
    )
    return ranking.list_measures(predicted, actual, "user_id", "item", k=5)


LISTS = """
lists AS (
  SELECT user_id, p.predicted, a.actual FROM
   (SELECT user_id, list(recommended_destination ORDER BY rank) AS predicted
    FROM recommendations GROUP BY user_id) p
   FULL JOIN (SELECT user_id, list(replace(search_query, 'hotels in ', '')) AS actual
    FROM searches WHERE user_id IS NOT NULL GROUP BY user_id) a USING (user_id)),
hits AS (
  SELECT user_id, i, list_contains(actual, predicted[i]) AS hit, actual
  FROM (SELECT *, unnest(range(1, 1 + least(5, len(predicted)))) AS i FROM lists)),
scored AS (
  SELECT l.user_id, coalesce(len(predicted), 0) > 0 AND coalesce(len(l.actual), 0) > 0 AS usable,
    len(list_distinct(l.actual)) AS relevant, len(l.actual) AS listed,
    count(*) FILTER (WHERE hit) AS hits, sum(CASE WHEN hit THEN 1.0::DOUBLE / log2(i + 1) ELSE 0 END) AS dcg
  FROM lists l LEFT JOIN hits h ON h.user_id = l.user_id GROUP BY ALL)"""
_CF_EV = (EV, *sql.CF, LISTS)


def _register_metric(name: str, expression: str, function) -> None:
    @register(
        name,
        sql.query(*_CF_EV, final=f"SELECT user_id, round(CASE WHEN usable THEN {expression} ELSE 0 END, 6) AS {name} FROM scored"),
    )
    def metric(spark, sf_dir):
        return _measures(spark, sf_dir).select("user_id", function(5).alias(name))


_register_metric("precision_at_k", "hits / 5.0::DOUBLE", ranking.precision_of)
_register_metric("recall_at_k", "hits::DOUBLE / relevant", ranking.recall_of)
_register_metric(
    "ndcg_at_k",
    "dcg / list_sum(list_transform(range(1, 1 + least(5, listed)), lambda j: 1.0::DOUBLE / log2(j + 1)))",
    ranking.ndcg_of,
)


@register(
    "map_at_k",
    sql.query(
        *_CF_EV,
        """running AS (SELECT *, count(*) FILTER (WHERE hit) OVER (PARTITION BY user_id ORDER BY i) AS h
           FROM hits)""",
        """ap AS (SELECT l.user_id, coalesce(sum(CASE WHEN hit THEN h::DOUBLE / i END), 0)
             / least(len(list_distinct(l.actual)), 5) AS ap
           FROM lists l LEFT JOIN running r ON r.user_id = l.user_id
           WHERE coalesce(len(l.actual), 0) > 0 GROUP BY l.user_id, l.actual)""",
        final="SELECT round(avg(ap), 6) AS map_at_k FROM ap",
    ),
)
def map_at_k(spark, sf_dir):
    return ranking.map_of(_measures(spark, sf_dir), 5)


@register(
    "hit_rate",
    sql.query(*_CF_EV, final="SELECT round(count(*) FILTER (WHERE hits > 0)::DOUBLE / count(*), 6) AS hit_rate FROM scored"),
)
def hit_rate(spark, sf_dir):
    return ranking.hit_rate_of(_measures(spark, sf_dir))


@register(
    "coverage",
    sql.query(
        *_CF_EV,
        final="""SELECT round((SELECT count(DISTINCT recommended_destination) FROM recommendations
        WHERE rank <= 2)::DOUBLE / (SELECT count(DISTINCT destination) FROM affinity), 6) AS coverage""",
    ),
)
def coverage(spark, sf_dir):
    return ranking.coverage_of(
        _recommendations(spark, sf_dir), _affinity(spark, sf_dir), "recommended_destination", "destination", k=2
    )


# ---------------------------------------------------------------- models

INTERACTIONS = """
interactions AS (
  SELECT user_id, search_query AS item_id, 1.0::DOUBLE AS rating FROM searches WHERE user_id IS NOT NULL
  UNION ALL SELECT user_id, result_destination, 3.0::DOUBLE FROM clicks WHERE user_id IS NOT NULL
  UNION ALL SELECT c.user_id, c.result_destination, 5.0::DOUBLE FROM clicks c
    JOIN conversions v ON v.click_event_id = c.event_id WHERE c.user_id IS NOT NULL)"""


def _interactions(spark, sf_dir) -> DataFrame:
    return recommender.interactions(*inputs.all_staged(spark, sf_dir))


@register("interactions", sql.query(EV, INTERACTIONS, final="SELECT * FROM interactions"))
def interactions(spark, sf_dir):
    return _interactions(spark, sf_dir)


@register(
    "ratings",
    sql.query(EV, INTERACTIONS, final="SELECT user_id, item_id, max(rating) AS rating FROM interactions GROUP BY ALL"),
)
def ratings(spark, sf_dir):
    return recommender.ratings(_interactions(spark, sf_dir))


@register(
    "user_history",
    sql.query(
        EV, INTERACTIONS,
        final="SELECT DISTINCT user_id, item_id FROM interactions",
    ),
)
def user_history(spark, sf_dir):
    return recommender.user_history(_interactions(spark, sf_dir))


RATED = (
    INTERACTIONS,
    "rated AS (SELECT user_id, item_id, max(rating) AS rating FROM interactions GROUP BY ALL)",
    "people AS (SELECT DISTINCT user_id FROM rated)",
)


@register(
    "svd_recommend",
    sql.query(
        EV, *RATED,
        final="""SELECT user_id, item_id, round(coalesce(rating, 0), 6) AS score,
        CAST(row_number() OVER (PARTITION BY user_id ORDER BY coalesce(rating, 0) DESC, item_id) AS INTEGER) AS rank
        FROM people CROSS JOIN (SELECT DISTINCT item_id FROM rated) LEFT JOIN rated USING (user_id, item_id)
        QUALIFY rank <= 10""",
    ),
)
def svd_recommend(spark, sf_dir):
    """With 50 factors for fewer items the product is the matrix itself, which is what SQL can say."""
    rated = recommender.ratings(_interactions(spark, sf_dir))
    return recommender.SvdRecommender(k=50).fit(rated).recommend(rated, 10)


@register("als_recommend")
def als_recommend(spark, sf_dir):
    rated = recommender.ratings(_interactions(spark, sf_dir))
    return recommender.AlsRecommender(rank=10, max_iter=5).fit(rated).recommend(10)


def _item_features(spark, sf_dir) -> DataFrame:
    """Per destination: price level, demand and booking share from clicks and bookings."""
    _, clicks, conversions = inputs.all_staged(spark, sf_dir)
    booked = conversions.select(F.col("click_event_id").alias("event_id"), F.lit(1).alias("_booked"))
    return (
        clicks.filter(F.col("result_destination").isNotNull())
        .join(booked.filter(F.col("event_id").isNotNull()).distinct(), "event_id", "left")
        .groupBy(F.col("result_destination").alias("item_id"))
        .agg(
            F.avg(F.col("result_price").cast("double")).alias("price_level"),
            F.count(F.lit(1)).cast("double").alias("popularity"),
            F.avg(F.coalesce("_booked", F.lit(0))).alias("booking_share"),
        )
    )


FEATURES = ("price_level", "popularity", "booking_share")


_TASTE = (
    """features AS (
  SELECT result_destination AS item_id, avg(result_price::DOUBLE) AS price_level, count(*)::DOUBLE AS popularity,
    avg(CASE WHEN event_id IN (SELECT click_event_id FROM conversions WHERE click_event_id IS NOT NULL) THEN 1.0::DOUBLE ELSE 0.0 END)
      AS booking_share
  FROM clicks WHERE result_destination IS NOT NULL GROUP BY ALL)""",
    "long AS (UNPIVOT features ON price_level, popularity, booking_share INTO NAME d VALUE x)",
    """scaled AS (SELECT item_id, d, (x - avg(x) OVER (PARTITION BY d))
    / coalesce(nullif(stddev_pop(x) OVER (PARTITION BY d), 0), 1) AS z FROM long)""",
    "unit AS (SELECT item_id, d, z / sqrt(sum(z * z) OVER (PARTITION BY item_id)) AS u FROM scaled)",
    "taste AS (SELECT user_id, d, avg(u) AS m FROM rated JOIN unit USING (item_id) GROUP BY ALL)",
    """content AS (SELECT t.user_id, unit.item_id, sum(t.m * unit.u) AS score FROM taste t JOIN unit ON unit.d = t.d GROUP BY ALL)""",
    """whole AS (SELECT user_id, item_id, round(0.6::DOUBLE * coalesce(rating, 0) + 0.4::DOUBLE * CASE
      WHEN rating IS NOT NULL AND item_id IN (SELECT item_id FROM features) THEN -1.0::DOUBLE ELSE coalesce(content.score, 0) END, 9) AS score
    FROM people CROSS JOIN (SELECT item_id FROM rated UNION SELECT item_id FROM features)
    LEFT JOIN rated USING (user_id, item_id) LEFT JOIN content USING (user_id, item_id))""",
)


@register(
    "hybrid_recommend",
    sql.query(
        EV, *RATED, *_TASTE,
        final="""SELECT user_id, item_id, round(score, 6) AS score,
        CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS INTEGER) AS rank FROM whole QUALIFY rank <= 10""",
    ),
)
def hybrid_recommend(spark, sf_dir):
    rated = recommender.ratings(_interactions(spark, sf_dir))
    model = recommender.HybridRecommender(FEATURES, k=50).fit(rated, _item_features(spark, sf_dir))
    return model.recommend(rated, 10)


_VECTORS = """
parts AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, unnest(range(1, 65)) AS d FROM embeddings),
scaled AS (SELECT vec_id, label, d, (x - avg(x) OVER (PARTITION BY d))
    / coalesce(nullif(stddev_pop(x) OVER (PARTITION BY d), 0), 1) AS z FROM parts),
unit AS (SELECT vec_id, label, d, z / sqrt(sum(z * z) OVER (PARTITION BY vec_id)) AS u FROM scaled),
profile AS (SELECT label, d, avg(u) AS m FROM unit GROUP BY ALL),
dots AS (SELECT p.label AS user_id, u.vec_id AS item_id,
    CASE WHEN p.label = u.label THEN -1.0::DOUBLE ELSE sum(p.m * u.u) END AS score
  FROM profile p JOIN unit u ON u.d = p.d GROUP BY p.label, u.vec_id, u.label)"""


@register(
    "content_recommend",
    f"""WITH {_VECTORS}
    SELECT user_id, item_id, round(score, 6) AS score,
      CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS INTEGER) AS rank
    FROM dots QUALIFY rank <= 10""",
)
def content_recommend(spark, sf_dir):
    """Every label likes its own vectors and is offered the closest of the others."""
    vectors = read_table(spark, sf_dir, "embeddings")
    dims = [f"d{i}" for i in range(64)]
    items = vectors.select(
        F.col("vec_id").alias("item_id"),
        *[F.col("embedding")[i].cast("double").alias(name) for i, name in enumerate(dims)],
    )
    likes = vectors.select(F.col("label").alias("user_id"), F.col("vec_id").alias("item_id"))
    return recommender.ContentRecommender(dims).fit(items).recommend(likes, 10)


CHURN_EVENTS = """
acts AS (
  SELECT user_id, session_id, 'search' AS kind, event_timestamp AS at_, search_query AS query, platform,
    NULL AS booking_value FROM searches WHERE user_id IS NOT NULL
  UNION ALL SELECT user_id, session_id, 'click', event_timestamp, NULL, NULL, NULL FROM clicks WHERE user_id IS NOT NULL
  UNION ALL SELECT user_id, session_id, 'conversion', event_timestamp, NULL, NULL, booking_value
    FROM conversions WHERE user_id IS NOT NULL)"""


def _churn_sql(as_of: str, source: str = "acts", duration: str | None = None) -> str:
    now = sql.ts(as_of)
    recent = ", ".join(
        f"count(DISTINCT CASE WHEN at_ > {now} - INTERVAL {d} DAY THEN session_id END) AS sessions_{d}d"
        for d in (7, 30, 90)
    )
    minutes = duration or f"""(SELECT avg(m) FROM (SELECT {sql.minutes('max(at_)', 'min(at_)')} AS m
      FROM {source} x WHERE x.user_id = a.user_id GROUP BY session_id))"""
    return f"""SELECT user_id, {recent},
      count(*) FILTER (WHERE kind = 'search') AS searches_total,
      count(*) FILTER (WHERE kind = 'click') AS clicks_total,
      count(*) FILTER (WHERE kind = 'conversion') AS conversions_total,
      round(count(*) FILTER (WHERE kind = 'click')::DOUBLE
        / greatest(count(*) FILTER (WHERE kind = 'search'), 1), 6) AS search_to_click_ratio,
      round(count(*) FILTER (WHERE kind = 'conversion')::DOUBLE
        / greatest(count(*) FILTER (WHERE kind = 'click'), 1), 6) AS click_to_conversion_ratio,
      round({minutes}, 6) AS avg_session_duration_mins,
      CAST(floor({sql.days(now, 'max(at_)')}) AS BIGINT) AS days_since_last_activity,
      round(coalesce(sum(booking_value), 0)::DOUBLE, 6) AS lifetime_value,
      count(DISTINCT query) AS unique_destinations_searched,
      round(count(*) FILTER (WHERE platform IN ('ios', 'android'))::DOUBLE / count(*), 6) AS mobile_session_ratio,
      round(count(*) FILTER (WHERE isodow(at_) >= 6)::DOUBLE / count(*), 6) AS weekend_session_ratio
    FROM {source} a GROUP BY user_id"""


def _acts(spark, sf_dir) -> DataFrame:
    return churn.churn_events(*inputs.all_staged(spark, sf_dir))


@register("churn_features", sql.query(EV, CHURN_EVENTS, final=_churn_sql(AS_OF)))
def churn_features(spark, sf_dir):
    return churn.churn_features(_acts(spark, sf_dir), AS_OF)


@register("churn_features_parity", sql.query(EV, CHURN_EVENTS, final=_churn_sql(AS_OF, duration="15.0::DOUBLE")))
def churn_features_parity(spark, sf_dir):
    return churn.churn_features(_acts(spark, sf_dir), AS_OF, placeholder_duration=True)


CUTOFF, HORIZON = "2024-01-28 00:00:00", 1


@register(
    "churn_training_set",
    sql.query(
        EV, CHURN_EVENTS, f"past AS (SELECT * FROM acts WHERE at_ < {sql.ts(CUTOFF)})",
        final=f"""SELECT f.*, CAST(CASE WHEN f.user_id IN (SELECT user_id FROM acts WHERE at_ >= {sql.ts(CUTOFF)}
          AND at_ < {sql.ts(CUTOFF)} + INTERVAL {HORIZON} DAY) THEN 0 ELSE 1 END AS INTEGER) AS churned
        FROM ({_churn_sql(CUTOFF, 'past')}) f""",
    ),
)
def churn_training_set(spark, sf_dir):
    return churn.churn_training_set(_acts(spark, sf_dir), CUTOFF, HORIZON)


_churn_models: dict = {}


def _churn_training(spark, sf_dir) -> DataFrame:
    path = scratch_path(spark, "churn")
    churn.churn_training_set(_acts(spark, sf_dir), CUTOFF, HORIZON).write.parquet(path)
    return spark.read.parquet(path)


def _churn(spark, sf_dir) -> churn.ChurnModel:
    """The model fitted on all users, once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _churn_models:
        _churn_models[key] = churn.ChurnModel().fit(_churn_training(spark, sf_dir))
    return _churn_models[key]


def _today(spark, sf_dir) -> DataFrame:
    """The features of all users as they are now."""
    return churn.churn_features(_acts(spark, sf_dir), AS_OF)


@register("churn_score")
def churn_score(spark, sf_dir):
    model = _churn(spark, sf_dir)
    return model.score(_today(spark, sf_dir)).select("user_id", "churn_probability", "prediction", "risk_level")


@register("churn_explain")
def churn_explain(spark, sf_dir):
    model = _churn(spark, sf_dir)
    return model.explain(_today(spark, sf_dir), 5).withColumn("top_factors", F.to_json("top_factors"))


@register("churn_feature_importance")
def churn_feature_importance(spark, sf_dir):
    model = _churn(spark, sf_dir)
    return model.feature_importance(spark)


@register("churn_evaluation")
def churn_evaluation(spark, sf_dir):
    """Fitted on four fifths of the users, measured on the rest."""
    training = _churn_training(spark, sf_dir)
    split = splits.stratified_split(training.select("user_id", "churned"), "churned", "user_id")
    parted = training.join(split.select("user_id", "is_test"), "user_id")
    model = churn.ChurnModel().fit(parted.filter("NOT is_test").drop("is_test"))
    scored = model.score(parted.filter("is_test").drop("is_test"))
    return evaluation.classifier_metrics(scored, "churned", "prediction", "churn_probability")


def _length_score(spark, sf_dir) -> DataFrame:
    """Every document with a score that grows with its length."""
    score = F.col("n_chars") / (F.col("n_chars") + F.lit(1000.0))
    return read_table(spark, sf_dir, "documents").select("doc_id", score.alias("score"))


def _judged(spark, sf_dir) -> DataFrame:
    """The labelled documents with their score and a prediction."""
    judged = _length_score(spark, sf_dir).join(read_table(spark, sf_dir, "labels"), "doc_id")
    return judged.select("doc_id", "quality", "score", (F.col("score") > 0.5).cast("int").alias("prediction"))


@register(
    "classifier_metrics",
    """WITH j AS (SELECT quality AS y, n_chars / (n_chars + 1000.0::DOUBLE) AS s FROM documents JOIN labels USING (doc_id)),
    p AS (SELECT *, CASE WHEN s > 0.5 THEN 1 ELSE 0 END AS p,
      rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0::DOUBLE AS r FROM j),
    c AS (SELECT count(*) AS n, count(*) FILTER (WHERE y = p) AS ok,
      (count(*) FILTER (WHERE y = 1 AND p = 1))::DOUBLE AS tp,
      count(*) FILTER (WHERE y = 0 AND p = 1) AS fp, count(*) FILTER (WHERE y = 1 AND p = 0) AS fn,
      (count(*) FILTER (WHERE y = 1))::DOUBLE AS pos, (count(*) FILTER (WHERE y = 0))::DOUBLE AS neg,
      sum(CASE WHEN y = 1 THEN r END) AS ranks FROM p)
    SELECT n AS rows, round(ok::DOUBLE / n, 6) AS accuracy, round(tp / (tp + fp), 6) AS precision,
      round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1,
      round((ranks - pos * (pos + 1) / 2) / (pos * neg), 6) AS auc FROM c""",
)
def classifier_metrics(spark, sf_dir):
    return evaluation.classifier_metrics(_judged(spark, sf_dir), "quality", "prediction", "score")


@register(
    "risk_level",
    """SELECT doc_id, CASE WHEN s < 0.3 THEN 'low' WHEN s < 0.7 THEN 'medium' ELSE 'high' END AS risk
    FROM (SELECT doc_id, n_chars / (n_chars + 1000.0::DOUBLE) AS s FROM documents)""",
)
def risk_level(spark, sf_dir):
    return _length_score(spark, sf_dir).select("doc_id", scalar.risk_level(F.col("score")).alias("risk"))


@register(
    "tfidf_vocabulary",
    r"""WITH words AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}') AS w FROM documents),
    terms AS (SELECT doc_id, list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS t
      FROM words),
    flat AS (SELECT doc_id, unnest(t) AS term FROM terms)
    SELECT term, count(*) AS tf, count(DISTINCT doc_id) AS df FROM flat
    GROUP BY term""",
)
def tfidf_vocabulary(spark, sf_dir):
    documents = read_table(spark, sf_dir, "documents")
    return sentiment.vocabulary(sentiment.with_terms(documents.select("text")))


@register("sentiment_score")
def sentiment_score(spark, sf_dir):
    """Document quality learnt from the labelled part, scored for every document."""
    documents = read_table(spark, sf_dir, "documents")
    labelled = documents.join(read_table(spark, sf_dir, "labels"), "doc_id").select(
        "text", F.col("quality").cast("string").alias("sentiment")
    )
    model = sentiment.SentimentModel(max_iter=100).fit(labelled)
    scored = model.transform(documents.select("doc_id", "text"))
    return scored.select(
        "doc_id", "predicted_sentiment", "confidence", F.to_json("probabilities").alias("probabilities")
    )


_DIGEST = "md5(doc_id || ':42')"


@register(
    "stratified_split",
    f"""SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY {_DIGEST}, doc_id)
      <= floor(count(*) OVER (PARTITION BY quality) * 0.2 + 0.5) AS is_test FROM labels""",
)
def stratified_split(spark, sf_dir):
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    return splits.stratified_split(labels, "quality", "doc_id")


@register(
    "user_holdout",
    sql.query(
        EV, INTERACTIONS,
        final="""SELECT user_id, item_id, rating,
        CAST('0x' || substr(md5(user_id || ':42'), 1, 8) AS BIGINT) < CAST(floor(0.2::DOUBLE * 4294967296) AS BIGINT)
          AS is_test FROM interactions""",
    ),
)
def user_holdout(spark, sf_dir):
    return splits.user_holdout(_interactions(spark, sf_dir))


# ---------------------------------------------------------------- streams


def _jsonl(spark, sf_dir, kinds=inputs.KINDS, closing: bool = False) -> str:
    """The payloads of some kinds as a folder of JSON-line files.

    With ``closing`` one more event, far beyond all windows, lets the stream give out all
    that it holds; its own window stays open, so it never shows in a result.
    """
    path = scratch_path(spark, "feed")
    parts = [inputs.raw(spark, sf_dir, k).select("payload") for k in kinds]
    if closing:
        event = {"event_id": "closing", "event_type": kinds[-1], "timestamp": "2100-01-01T00:00:00Z"}
        names = ("user_id", "session_id", "search_event_id", "click_event_id")
        line = json.dumps({**event, **{name: f"no {name}" for name in names}})
        parts.append(spark.createDataFrame([(line,)], "payload string"))
    lines = parts[0]
    for part in parts[1:]:
        lines = lines.unionByName(part)
    lines.write.text(path)
    return path


def _drain(spark, df: DataFrame, mode: str = "append") -> DataFrame:
    """Runs a stream over all available files into Parquet and reads the result."""
    path = scratch_path(spark, "out")
    streaming.write_stream(df, path, scratch_path(spark, "state"), mode=mode).awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


def _stream_stage_columns(columns: str) -> str:
    return " ".join(c for c in columns.split() if not c.startswith("ingested_at"))


@register(
    "stream_staging",
    sql.query(EV, final=select(_stream_stage_columns(SEARCH_COLUMNS), "searches")),
)
def stream_staging(spark, sf_dir):
    feed = stream_events(spark, _jsonl(spark, sf_dir, ("search",)))
    return _drain(spark, streaming.stream_staging(feed, "search").drop("ingested_at"))


@register("stream_dedupe", sql.query(EV, final="SELECT event_id, search_query FROM searches"))
def stream_dedupe(spark, sf_dir):
    """Every search line occurs twice in the files."""
    path = _jsonl(spark, sf_dir, ("search", "search"))
    staged = streaming.stream_staging(stream_events(spark, path), "search")
    return _drain(spark, streaming.stream_dedupe(staged).select("event_id", "search_query"))


def _all_kinds(spark, sf_dir) -> DataFrame:
    return streaming.stream_staging(stream_events(spark, _jsonl(spark, sf_dir, closing=True)), "search")


_ALL = """
everything AS (
  SELECT event_type, event_timestamp, user_id FROM searches UNION ALL
  SELECT event_type, event_timestamp, user_id FROM clicks UNION ALL
  SELECT event_type, event_timestamp, user_id FROM conversions)"""
_KINDS = """count(*) FILTER (WHERE event_type = 'search') AS searches,
  count(*) FILTER (WHERE event_type = 'click') AS clicks,
  count(*) FILTER (WHERE event_type = 'conversion') AS conversions"""


def _window_sql(starts: str) -> str:
    return f"""SELECT strftime(s, '%Y-%m-%d %H:%M:%S.%f') AS window_start,
      strftime(s + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS window_end, searches, clicks, conversions,
      round({sql.over('clicks', 'searches')}, 6) AS click_through_rate
    FROM (SELECT {starts} AS s, {_KINDS} FROM everything, shifts GROUP BY ALL)"""


@register(
    "stream_funnel",
    sql.query(EV, _ALL, "shifts AS (SELECT 0 AS shift)", final=_window_sql("date_trunc('hour', event_timestamp)")),
)
def stream_funnel(spark, sf_dir):
    return _drain(spark, streaming.stream_funnel(_all_kinds(spark, sf_dir), size="1 hour"))


@register(
    "stream_ctr_sliding",
    sql.query(
        EV, _ALL, "shifts AS (SELECT unnest([0, 15, 30, 45]) AS shift)",
        final=_window_sql("time_bucket(INTERVAL 15 MINUTE, event_timestamp) - to_minutes(shift)"),
    ),
)
def stream_ctr_sliding(spark, sf_dir):
    windows = streaming.stream_funnel(_all_kinds(spark, sf_dir), size="1 hour", slide="15 minutes")
    return _drain(spark, windows)


@register(
    "stream_sessions",
    sql.query(
        EV, _ALL,
        """cuts AS (SELECT *, CASE WHEN epoch_us(event_timestamp) - epoch_us(lag(event_timestamp) OVER w)
             < 30 * 60000000 THEN 0 ELSE 1 END AS opens FROM everything WHERE user_id IS NOT NULL
             WINDOW w AS (PARTITION BY user_id ORDER BY event_timestamp))""",
        """nums AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY event_timestamp) AS num FROM cuts)""",
        final=f"""SELECT user_id, strftime(a, '%Y-%m-%d %H:%M:%S.%f') AS session_start,
        strftime(b, '%Y-%m-%d %H:%M:%S.%f') AS session_end, events, searches AS search_count,
        clicks AS click_count, conversions AS conversion_count
        FROM (SELECT user_id, min(event_timestamp) AS a, max(event_timestamp) + INTERVAL 30 MINUTE AS b,
              count(*) AS events, {_KINDS} FROM nums GROUP BY user_id, num)""",
    ),
)
def stream_sessions(spark, sf_dir):
    return _drain(spark, streaming.stream_sessions(_all_kinds(spark, sf_dir)))


@register(
    "stream_journeys",
    sql.query(
        EV,
        final=f"""SELECT s.event_id AS search_event_id, c.event_id AS click_event_id, v.event_id AS conversion_event_id,
        s.user_id, s.search_query, strftime(s.event_timestamp, '%Y-%m-%d %H:%M:%S.%f') AS search_timestamp,
        strftime(c.event_timestamp, '%Y-%m-%d %H:%M:%S.%f') AS click_timestamp,
        strftime(v.event_timestamp, '%Y-%m-%d %H:%M:%S.%f') AS conversion_timestamp,
        c.result_destination, round(v.booking_value, 6) AS booking_value,
        CASE WHEN v.event_id IS NOT NULL THEN 'converted' WHEN c.event_id IS NOT NULL THEN 'clicked'
          ELSE 'searched_only' END AS journey_stage
        FROM searches s LEFT JOIN clicks c ON c.search_event_id = s.event_id
          AND c.event_timestamp BETWEEN s.event_timestamp AND s.event_timestamp + INTERVAL 24 HOUR
        LEFT JOIN conversions v ON v.click_event_id = c.event_id
          AND v.event_timestamp BETWEEN s.event_timestamp AND s.event_timestamp + INTERVAL 48 HOUR""",
    ),
)
def stream_journeys(spark, sf_dir):
    feeds = {
        kind: streaming.stream_staging(stream_events(spark, _jsonl(spark, sf_dir, (kind,), closing=True)), kind)
        for kind in inputs.KINDS
    }
    return _drain(spark, streaming.stream_journeys(feeds["search"], feeds["click"], feeds["conversion"]))


from registry.queries import _DIFFERS, CRM, TWO_SYNCS, _merged_sql  # noqa: E402


@register(
    "stream_merge_segments",
    sql.query(*TWO_SYNCS, _merged_sql(activation.CRM_ATTRIBUTES, True), final=select(CRM, "merged")),
)
def stream_merge_segments(spark, sf_dir):
    """Two segment snapshots arrive one after the other and are merged into the CRM table."""
    inbox, root = scratch_path(spark, "inbox"), scratch_path(spark, "crm")
    _segments(spark, sf_dir, EARLIER).write.mode("append").parquet(inbox)
    schema = spark.read.parquet(inbox).schema
    state = scratch_path(spark, "state")

    def merge(current, batch):
        # The snapshot's own clock is the clock of its sync.
        return activation.merge_segments(current, batch, batch.select(F.max("segmented_at")).scalar())

    crm = Snapshot(spark, root, activation.CRM_SCHEMA)

    for arriving in (None, AS_OF):
        if arriving:
            _segments(spark, sf_dir, arriving).write.mode("append").parquet(inbox)
        feed = spark.readStream.schema(schema).parquet(inbox)
        streaming.merge_stream(feed, crm.merging(merge), state, mode="append").awaitTermination()
    return crm.latest()


@register(
    "ingest_run",
    sql.query(
        EV,
        final=" UNION ALL ".join(
            f"""SELECT '{kind}' AS feed, count(*) AS lines_read, CAST(0 AS BIGINT) AS malformed,
            CAST(0 AS BIGINT) AS without_id, count(*) AS inserted FROM {table}"""
            for kind, table in (("search", "searches"), ("click", "clicks"), ("conversion", "conversions"))
        ),
    ),
)
def ingest_run(spark, sf_dir):
    """The three feeds into empty raw tables, with the counts as logged."""
    catalog = Catalog(spark, scratch_path(spark, "ingest-run"))
    feeds = {kind: _jsonl(spark, sf_dir, (kind,)) for kind in inputs.KINDS}
    log = flow.run_ingest(catalog, feeds, "batch-1", AS_OF)
    return log.select("feed", "lines_read", "malformed", "without_id", "inserted")


@register(
    "sync_twice",
    sql.query(
        *TWO_SYNCS,
        final=f"""SELECT strftime({sql.ts(EARLIER)}, '%Y-%m-%d %H:%M:%S.%f') AS high_water_mark, count(*) AS rows_extracted,
          count(*) AS rows_upserted, CAST(0 AS BIGINT) AS rows_unchanged FROM old
        UNION ALL SELECT strftime({sql.ts(AS_OF)}, '%Y-%m-%d %H:%M:%S.%f'), count(*),
          count(*) FILTER (WHERE o.user_id IS NULL OR {_DIFFERS}),
          count(*) FILTER (WHERE o.user_id IS NOT NULL AND NOT ({_DIFFERS})) FROM new n LEFT JOIN old o ON o.user_id = n.user_id
        UNION ALL SELECT strftime({sql.ts(AS_OF)}, '%Y-%m-%d %H:%M:%S.%f'), 0, 0, 0""",
    ),
)
def sync_twice(spark, sf_dir):
    """Two builds of the segments, each synced with its own clock in the past, and a sync with nothing new: the log."""
    catalog = Catalog(spark, scratch_path(spark, "sync-twice"))
    for at in (EARLIER, AS_OF, None):
        if at:
            catalog.materialize(_segments(spark, sf_dir, at), "marketing.mart_user_segments")
        flow.run_named_syncs(catalog, ("segments",), as_of=at or AS_OF)
    log = spark.read.schema(activation.SYNC_LOG_SCHEMA).parquet(catalog.resolve("ops.sync_log"))
    return log.select("high_water_mark", "rows_extracted", "rows_upserted", "rows_unchanged")


_THIRD = "CAST('0x' || substr(md5(event_id), 1, 8) AS BIGINT) % 3"


@register(
    "stream_late_rows",
    sql.query(
        EV, _ALL.replace("event_type, event_timestamp", "event_id, event_type, event_timestamp"),
        f"mark AS (SELECT max(epoch_us(event_timestamp)) // 1000 - 24 * 3600000 AS ms FROM everything WHERE {_THIRD} = 0)",
        final=f"""SELECT event_id, event_type, strftime(event_timestamp, '%Y-%m-%d %H:%M:%S.%f') AS event_timestamp,
        strftime(make_timestamp(ms * 1000), '%Y-%m-%d %H:%M:%S.%f') AS missed_watermark,
        round((ms * 1000 - epoch_us(event_timestamp)) / 1000000.0::DOUBLE, 6) AS late_by_seconds
        FROM everything, mark WHERE {_THIRD} = 2 AND epoch_us(event_timestamp) <= ms * 1000""",
    ),
)
def stream_late_rows(spark, sf_dir):
    """The events arrive in three batches: what of the third one is behind the mark of the first."""
    inbox, root, state = (scratch_path(spark, n) for n in ("inbox", "split", "state"))
    events = [inputs.staged(spark, sf_dir, kind).select("event_id", "event_type", "event_timestamp") for kind in inputs.KINDS]
    events = events[0].unionByName(events[1]).unionByName(events[2])
    third = F.conv(F.substring(F.md5("event_id"), 1, 8), 16, 10).cast("long") % 3
    for arriving in range(3):
        events.filter(third == arriving).write.mode("append").parquet(inbox)
        feed = spark.readStream.schema(events.schema).parquet(inbox)
        late.split_stream(feed, root, state).awaitTermination()
    return late.late_rows(spark, root, events.schema).drop("batch")

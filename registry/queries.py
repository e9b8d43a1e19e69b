"""The registered queries: each a Spark function with, where SQL can say it, its twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import inputs, sql
from registry.sql import AS_OF, EARLIER, select
from tripfunnel.functions import ranking, scalar
from tripfunnel.models import churn, evaluation, recommender, sentiment, splits
from tripfunnel.operators import activation, journeys, quality, reporting, rows, sessions, staging, timeline
from tripfunnel.plans import marts, recommendations, rules
from tripfunnel.session import scratch_path, use_utc
from tripfunnel.sources import raw as raw_layer
from tripfunnel.sources import reviews
from tripfunnel.sources.catalog import Catalog
from tripfunnel.sources.events_adapter import clickstream, read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def tidy(df: DataFrame) -> DataFrame:
    """Portable output types: decimals and doubles as rounded doubles, times as text."""
    shaped = []
    for field in df.schema.fields:
        kind, c = field.dataType.typeName(), F.col(f"`{field.name}`")
        if kind in ("double", "float", "decimal"):
            # Spelt out, because engines differ in how they round a binary tie; the limit lies
            # beside the half, so that the last bit of a sum does not decide a tie.
            c = F.floor(c.cast("double") * 1e6 + 0.5001) / 1e6
        elif kind in ("timestamp", "timestamp_ntz"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif kind == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        shaped.append(c.alias(field.name))
    return df.select(*shaped)


def register(name: str, oracle: str | None = None):
    def wrap(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return tidy(build(use_utc(spark), sf_dir))

        QUERIES[name] = run
        if oracle:
            ORACLE[name] = sql.portable_rounding(oracle)
        return build

    return wrap


# ---------------------------------------------------------------- shared inputs


def _sessions(spark, sf_dir, gap: int = 1440, before: str | None = None) -> DataFrame:
    parts = inputs.all_staged(spark, sf_dir, gap)
    if before:
        parts = [p.filter(F.col("event_timestamp") < F.lit(before).cast("timestamp")) for p in parts]
    return sessions.search_sessions(*parts)


def _journeys(spark, sf_dir) -> DataFrame:
    return journeys.user_journeys(*inputs.all_staged(spark, sf_dir))


def _funnel(spark, sf_dir) -> DataFrame:
    return marts.search_funnel(_sessions(spark, sf_dir))


def _users(spark, sf_dir) -> DataFrame:
    return marts.user_dimension(_sessions(spark, sf_dir), AS_OF)


def _segments(spark, sf_dir, as_of: str = AS_OF) -> DataFrame:
    """The segment mart as a run at ``as_of`` would have built it."""
    searches, clicks, conversions = (
        p.filter(F.col("event_timestamp") < F.lit(as_of).cast("timestamp"))
        for p in inputs.all_staged(spark, sf_dir)
    )
    users = marts.user_dimension(sessions.search_sessions(searches, clicks, conversions), as_of)
    return marts.user_segments(users, searches, conversions, as_of)


def _affinity(spark, sf_dir) -> DataFrame:
    _, clicks, conversions = inputs.all_staged(spark, sf_dir)
    return recommendations.user_destinations(clicks, conversions)


def _recommendations(spark, sf_dir) -> DataFrame:
    _, clicks, conversions = inputs.all_staged(spark, sf_dir)
    return recommendations.recommend_user_cf(clicks, conversions, AS_OF)


def _run_log(spark, sf_dir) -> DataFrame:
    """A run log derived from ``events``: one run per event type and day."""
    return (
        read_table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("dag_id"), F.to_date("ts").alias("day"))
        .agg(
            F.min("ts").alias("started_at"),
            F.max("ts").alias("completed_at"),
            F.count(F.lit(1)).alias("rows_processed"),
        )
        .select(
            F.concat_ws("-", "dag_id", F.date_format("day", "yyyyMMdd")).alias("run_id"),
            "dag_id",
            "started_at",
            "completed_at",
            F.when(F.col("dag_id") == "error", "failed").otherwise("success").alias("status"),
            "rows_processed",
        )
    )


RUN_LOG = """
runs AS (
  SELECT event_type || '-' || strftime(ts, '%Y%m%d') AS run_id, event_type AS dag_id,
    min(ts) AS started_at, max(ts) AS completed_at,
    CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
    count(*) AS rows_processed
  FROM events GROUP BY event_type, strftime(ts, '%Y%m%d'))"""
RUN_COLUMNS = "run_id dag_id started_at:ts completed_at:ts status rows_processed:big"

# ---------------------------------------------------------------- sources and staging

EV = sql.events()


def _feed_lines(spark, sf_dir) -> DataFrame:
    payloads = [inputs.raw(spark, sf_dir, k).select(F.col("payload").alias("line")) for k in inputs.KINDS]
    return payloads[0].unionByName(payloads[1]).unionByName(payloads[2])


@register(
    "load_raw",
    sql.query(
        EV,
        final="""SELECT event_id, event_type, user_id, session_id FROM searches
        UNION ALL SELECT event_id, event_type, user_id, session_id FROM clicks
        UNION ALL SELECT event_id, event_type, user_id, session_id FROM conversions""",
    ),
)
def load_raw(spark, sf_dir):
    """Writes all documents as JSON lines, with blank and cut-off lines in between, and loads them."""
    path = scratch_path(spark, "jsonl")
    lines = _feed_lines(spark, sf_dir)
    cut_off = lines.select(F.expr("substring(line, 1, length(line) - 5)").alias("line"))
    lines.unionByName(lines.select(F.lit("   ").alias("line"))).unionByName(cut_off).write.text(path)
    loaded = raw_layer.load_raw(
        spark, path, scratch_path(spark, "raw"), AS_OF, scratch_path(spark, "raw-rejects")
    )
    doc = lambda name: F.get_json_object("payload", f"$.{name}").alias(name)
    return loaded.select("event_id", doc("event_type"), doc("user_id"), doc("session_id"))


@register(
    "missing_source",
    sql.query(
        EV,
        final="""SELECT 'feed' AS source_file, (SELECT count(*) FROM searches)
        + (SELECT count(*) FROM clicks) + (SELECT count(*) FROM conversions) AS lines""",
    ),
)
def missing_source(spark, sf_dir):
    """A feed without a file: zero rows next to the documents that do exist."""
    absent = raw_layer.read_jsonl(spark, f"{sf_dir}/no_such_feed")
    present = _feed_lines(spark, sf_dir).withColumn("source_file", F.lit("feed"))
    return absent.unionByName(present).groupBy("source_file").agg(F.count(F.lit(1)).alias("lines"))


def _ingest(spark, sf_dir) -> raw_layer.IngestResult:
    """A batch of all searches, sent twice, with broken lines and lines without id."""
    known = inputs.known_ids(spark, sf_dir, "2024-01-16 00:00:00")
    lines = inputs.raw(spark, sf_dir, "search").select(F.col("payload").alias("line"))
    events = read_table(spark, sf_dir, "events")
    broken = events.filter(F.col("event_type") == "error").select(
        F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string")).alias("line")
    )
    nameless = events.filter(F.col("event_type") == "signup").select(F.col("props").alias("line"))
    batch = lines.unionByName(lines).unionByName(broken).unionByName(nameless)
    return raw_layer.ingest_incremental(
        batch.withColumn("source_file", F.lit("batch.jsonl")), known, "batch-1", AS_OF
    )


LATE_HALF = "event_timestamp >= TIMESTAMP '2024-01-16 00:00:00'"


@register(
    "ingest_new_rows",
    sql.query(
        EV,
        final=f"""SELECT event_id, 'batch.jsonl' AS source_file, 'batch-1' AS batch_id,
        '{AS_OF}.000000' AS ingested_at FROM searches WHERE {LATE_HALF}""",
    ),
)
def ingest_new_rows(spark, sf_dir):
    return _ingest(spark, sf_dir).new_rows.select("event_id", "source_file", "batch_id", "ingested_at")


@register(
    "ingest_rejects",
    """SELECT CASE event_type WHEN 'error' THEN 'malformed_json' ELSE 'missing_event_id' END AS reason,
    CASE event_type WHEN 'error' THEN '{"event_id": ' || event_id ELSE props END AS payload
    FROM events WHERE event_type IN ('error', 'signup')""",
)
def ingest_rejects(spark, sf_dir):
    return _ingest(spark, sf_dir).rejects.select("reason", "payload")


@register(
    "ingest_metrics",
    sql.query(
        EV,
        final=f"""SELECT *, lines_read - malformed - without_id - inserted AS already_known,
        'batch-1' AS batch_id FROM (SELECT
          2 * (SELECT count(*) FROM searches) + count(*) AS lines_read,
          count(*) FILTER (WHERE event_type = 'error') AS malformed,
          count(*) FILTER (WHERE event_type = 'signup') AS without_id,
          (SELECT count(*) FROM searches WHERE {LATE_HALF}) AS inserted
        FROM events WHERE event_type IN ('error', 'signup'))""",
    ),
)
def ingest_metrics(spark, sf_dir):
    return _ingest(spark, sf_dir).metrics


@register(
    "read_reviews",
    """SELECT CAST(quality AS VARCHAR) AS sentiment, md5(text) AS digest, length(text) AS chars
    FROM documents JOIN labels USING (doc_id)""",
)
def read_reviews(spark, sf_dir):
    """Labelled documents through the CSV sink and back."""
    path = scratch_path(spark, "reviews")
    labelled = read_table(spark, sf_dir, "documents").join(
        read_table(spark, sf_dir, "labels"), "doc_id"
    )
    reviews.write_reviews(
        labelled.select("text", F.col("quality").cast("string").alias("sentiment")), path
    )
    return reviews.read_reviews(spark, path).select(
        "sentiment",
        F.md5(F.col("text").cast("binary")).alias("digest"),
        F.length("text").cast("long").alias("chars"),
    )


SEARCH_COLUMNS = (
    "event_id event_type event_timestamp:ts user_id session_id search_query results_count page_number:int "
    "platform device_type geo_country geo_city utm_source utm_medium utm_campaign ingested_at:ts"
)
CLICK_COLUMNS = (
    "event_id event_type event_timestamp:ts user_id session_id search_event_id result_position result_id "
    "result_type result_price:num result_provider result_destination ingested_at:ts"
)
CONVERSION_COLUMNS = (
    "event_id event_type event_timestamp:ts user_id session_id click_event_id booking_value:num "
    "commission:num currency product_type provider ingested_at:ts"
)


def _register_stage(kind: str, columns: str, table: str) -> None:
    @register(f"stage_{kind}", sql.query(EV, final=select(columns, table)))
    def stage(spark, sf_dir):
        return staging.stage(inputs.raw(spark, sf_dir, kind), kind)


_register_stage("search", SEARCH_COLUMNS, "searches")
_register_stage("click", CLICK_COLUMNS, "clicks")
_register_stage("conversion", CONVERSION_COLUMNS, "conversions")


@register(
    "dedupe_latest",
    sql.query(
        EV,
        final="""SELECT event_id, 'search' AS event_type, 'replaced query' AS search_query,
        strftime(ingested_at + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS ingested_at FROM searches""",
    ),
)
def dedupe_latest(spark, sf_dir):
    """Every search arrives again an hour later with another query text."""
    first = inputs.raw(spark, sf_dir, "search")
    again = first.select(
        "event_id",
        F.regexp_replace("payload", '"query":"[^"]*"', '"query":"  Replaced QUERY "').alias("payload"),
        (F.col("ingested_at") + F.make_dt_interval(hours=F.lit(1))).alias("ingested_at"),
    )
    staged = staging.stage_search(first.unionByName(again))
    return staged.select("event_id", "event_type", "search_query", "ingested_at")


@register(
    "staging_rejects",
    sql.query(
        EV,
        final="""SELECT event_id, 'results_count' AS bad_fields FROM searches
        WHERE results_count % 7 = 0""",
    ),
)
def staging_rejects(spark, sf_dir):
    """Counts divisible by seven arrive as words."""
    feed = inputs.raw(spark, sf_dir, "search")
    count = F.get_json_object("payload", "$.results_count").cast("int")
    worded = F.regexp_replace("payload", '"results_count":[0-9]+', '"results_count":"many"')
    damaged = feed.withColumn("payload", F.when(count % 7 == 0, worded).otherwise(F.col("payload")))
    return staging.staging_rejects(damaged, "search").select("event_id", "bad_fields")


def _malformed(spark, sf_dir) -> DataFrame:
    """Every search, and by turns a newer version of it that is no event: cut off, an array,
    plain text, two objects on one line, text after the object, single quotes, text instead
    of an object, no id.
    """
    feed = inputs.raw(spark, sf_dir, "search")
    payload = F.col("payload")
    versions = (
        F.expr("substring(payload, 1, length(payload) - 9)"),
        F.concat(F.lit("["), payload, F.lit("]")),
        F.lit("no event"),
        F.concat(payload, F.lit(" "), payload),
        F.concat(payload, F.lit("}} {{")),
        F.replace(payload, F.lit('"'), F.lit("'")),
        F.regexp_replace(payload, '"geo":[{][^}]*[}]', '"geo":"somewhere"'),
        payload,
    )
    turn = F.pmod(F.crc32(F.col("event_id").cast("binary")), F.lit(len(versions)))
    newer = feed.withColumn("payload", F.element_at(F.array(*versions), (turn + 1).cast("int"))).withColumn(
        "ingested_at", F.col("ingested_at") + F.make_dt_interval(hours=F.lit(1))
    )
    nameless = F.when(turn == len(versions) - 1, F.lit(None).cast("string")).otherwise(F.col("event_id"))
    return feed.unionByName(newer.withColumn("event_id", nameless))


@register(
    "staging_malformed",
    sql.query(EV, final="SELECT event_id, event_type, search_query, platform FROM searches"),
)
def staging_malformed(spark, sf_dir):
    """The good version survives a newer one that is no event."""
    staged = staging.stage_search(_malformed(spark, sf_dir))
    return staged.select("event_id", "event_type", "search_query", "platform")


@register(
    "staging_malformed_rejects",
    sql.query(EV, final="SELECT count(*) AS rejects, count(*) AS rows_with_reason FROM searches"),
)
def staging_malformed_rejects(spark, sf_dir):
    """Every broken line is in the rejects with its reason."""
    refused = staging.staging_rejects(_malformed(spark, sf_dir), "search")
    named = F.col("bad_fields").isin("malformed_json", "missing_event_id", "geo")
    return refused.agg(F.count(F.lit(1)).alias("rejects"), F.count_if(named).alias("rows_with_reason"))


# ---------------------------------------------------------------- sessions and journeys


def _register_sessions(gap: int) -> None:
    base = sql.events(gap)

    @register(
        f"sessionize_{gap}",
        sql.query(base, final="SELECT event_id, uid AS user_id, session_number FROM numbered JOIN "
                  "(SELECT event_id, n FROM feed) USING (n)"),
    )
    def sessionize(spark, sf_dir):
        stream = clickstream(spark, sf_dir, gap).drop("session_number")
        return timeline.sessionize(stream, timeout_minutes=gap).select(
            F.col("n").cast("string").alias("event_id"), "user_id", "session_number"
        )

    columns = (
        "session_id user_id session_start:ts session_end:ts session_duration_minutes:num search_count "
        "unique_queries click_count avg_click_position:num conversion_count total_booking_value:num "
        "total_commission:num platform device_type geo_country utm_source utm_campaign session_ctr:num "
        "session_conversion_rate:num session_outcome"
    )

    @register(f"search_sessions_{gap}", sql.query(base, sql.sessions(), final=select(columns, "sessions")))
    def search_sessions(spark, sf_dir):
        return _sessions(spark, sf_dir, gap)


_register_sessions(30)
_register_sessions(1440)


@register(
    "first_per_group",
    sql.query(
        EV,
        final="""SELECT session_id, platform, device_type, geo_country, utm_source, utm_campaign
        FROM searches QUALIFY row_number() OVER (PARTITION BY session_id
        ORDER BY event_timestamp, event_id) = 1""",
    ),
)
def first_per_group(spark, sf_dir):
    searches = inputs.staged(spark, sf_dir, "search")
    first = rows.first_per_group(
        searches, ["session_id"], [F.col("event_timestamp").asc_nulls_last(), F.col("event_id")]
    )
    return first.select("session_id", *sessions.CONTEXT)


@register(
    "session_clicks",
    sql.query(
        EV,
        final="""SELECT session_id, count(*) AS click_count,
        round(avg(result_position), 6) AS avg_click_position,
        round(CAST(sum(result_price) AS DOUBLE), 6) AS total_clicked_value FROM clicks GROUP BY session_id""",
    ),
)
def session_clicks(spark, sf_dir):
    return sessions.session_clicks(inputs.staged(spark, sf_dir, "click"))


@register(
    "session_conversions",
    sql.query(
        EV,
        final="""SELECT session_id, count(*) AS conversion_count,
        round(CAST(sum(booking_value) AS DOUBLE), 6) AS total_booking_value,
        round(CAST(sum(commission) AS DOUBLE), 6) AS total_commission
        FROM conversions GROUP BY session_id""",
    ),
)
def session_conversions(spark, sf_dir):
    return sessions.session_conversions(inputs.staged(spark, sf_dir, "conversion"))


JOURNEY_COLUMNS = (
    "search_event_id click_event_id conversion_event_id user_id session_id search_timestamp:ts "
    "search_query search_results_count platform device_type geo_country utm_source utm_campaign "
    "click_timestamp:ts result_position result_type result_price:num result_destination "
    "result_provider conversion_timestamp:ts booking_value:num commission:num converted_product_type "
    "search_to_click_minutes:num click_to_conversion_minutes:num search_to_conversion_minutes:num "
    "journey_stage is_converted attributed_revenue:num attributed_commission:num"
)


@register("user_journeys", sql.query(EV, sql.JOURNEYS, final=select(JOURNEY_COLUMNS, "journeys")))
def user_journeys(spark, sf_dir):
    return _journeys(spark, sf_dir)


def _touches(pick: str) -> str:
    return f"""SELECT v.event_id, {pick} FROM conversions v LEFT JOIN searches s
      ON s.user_id = v.user_id AND s.event_timestamp <= v.event_timestamp
     AND s.event_timestamp >= v.event_timestamp - INTERVAL 24 HOUR GROUP BY v.event_id"""


def _register_attribution(model: str, pick: str, columns: tuple[str, ...]) -> None:
    @register(f"attribute_{model}", sql.query(EV, final=_touches(pick)))
    def attribute(spark, sf_dir):
        searches, _, conversions = inputs.all_staged(spark, sf_dir)
        credited = journeys.attribute(conversions, searches, 24, model)
        return credited.select("event_id", *columns)


_TOUCH = ("touch_event_id", "touch_timestamp")
_BEST = """arg_max(s.event_id, ({sign}epoch_us(s.event_timestamp), s.event_id)) AS touch_event_id,
  strftime({best}(s.event_timestamp), '%Y-%m-%d %H:%M:%S.%f') AS touch_timestamp"""
_register_attribution("last", _BEST.format(sign="", best="max"), _TOUCH)
_register_attribution("first", _BEST.format(sign="-", best="min"), _TOUCH)
_register_attribution("any", "count(s.event_id) AS touch_count", ("touch_count",))

# ---------------------------------------------------------------- marts

FUNNEL_COLUMNS = (
    "funnel_date:date platform device_type geo_country utm_source utm_campaign total_sessions "
    "total_searches total_clicks total_conversions total_revenue:num total_commission:num "
    "click_through_rate:num conversion_rate:num search_to_conversion_rate:num "
    "avg_session_duration_minutes:num avg_click_position:num avg_queries_per_session:num "
    "avg_order_value:num revenue_per_session:num converted_sessions engaged_sessions bounced_sessions"
)
USER_COLUMNS = (
    "user_id first_seen_at:ts last_seen_at:ts days_since_last_seen:num account_age_days:num "
    "total_sessions lifetime_searches lifetime_clicks lifetime_conversions lifetime_revenue:num "
    "lifetime_commission:num primary_platform primary_device primary_country avg_session_duration:num "
    "avg_ctr:num avg_conversion_rate:num lifetime_ctr:num lifetime_conversion_rate:num "
    "revenue_per_session:num avg_order_value:num"
)
SEGMENT_COLUMNS = (
    "user_id segment engagement_score lifetime_revenue:num lifetime_conversions lifetime_searches "
    "first_seen_at:ts last_seen_at:ts days_since_last_seen:num account_age_days:num primary_platform "
    "primary_country segmented_at:ts"
)
SESSIONS = (EV, sql.sessions())
FUNNEL = (*SESSIONS, sql.funnel())
USERS = (*SESSIONS, sql.users())
SEGMENTS = (*USERS, sql.segments())


@register("search_funnel", sql.query(*FUNNEL, final=select(FUNNEL_COLUMNS, "funnel")))
def search_funnel(spark, sf_dir):
    return _funnel(spark, sf_dir)


@register("user_dimension", sql.query(*USERS, final=select(USER_COLUMNS, "users")))
def user_dimension(spark, sf_dir):
    return _users(spark, sf_dir)


def _most_frequent(column: str) -> str:
    return f"""(SELECT {column} FROM sessions x WHERE x.user_id = u.user_id AND {column} IS NOT NULL
      GROUP BY {column} ORDER BY count(*) DESC, {column} LIMIT 1)"""


@register(
    "user_dimension_mode",
    sql.query(
        *USERS,
        final=f"""SELECT user_id, {_most_frequent('platform')} AS primary_platform,
        {_most_frequent('device_type')} AS primary_device,
        {_most_frequent('geo_country')} AS primary_country FROM users u""",
    ),
)
def user_dimension_mode(spark, sf_dir):
    users = marts.user_dimension(_sessions(spark, sf_dir), AS_OF, primary="mode")
    return users.select("user_id", "primary_platform", "primary_device", "primary_country")


@register("user_segments", sql.query(*SEGMENTS, final=select(SEGMENT_COLUMNS, "segments")))
def user_segments(spark, sf_dir):
    return _segments(spark, sf_dir)


@register(
    "user_segments_earlier",
    sql.query(
        EV,
        sql.sessions("sessions", EARLIER),
        sql.users(as_of=EARLIER),
        sql.segments(as_of=EARLIER, before=EARLIER),
        final=select(SEGMENT_COLUMNS, "segments"),
    ),
)
def user_segments_earlier(spark, sf_dir):
    return _segments(spark, sf_dir, EARLIER)


@register("engagement_score", sql.query(*SEGMENTS, final="SELECT user_id, engagement_score FROM segments"))
def engagement_score(spark, sf_dir):
    score = scalar.engagement_score(
        F.col("lifetime_conversions"), F.col("total_sessions"), F.col("avg_ctr"),
        F.col("days_since_last_seen"),
    )
    return _users(spark, sf_dir).select("user_id", score.alias("engagement_score"))


@register(
    "segment_distribution",
    sql.query(*SEGMENTS, final="SELECT segment, count(*) AS users FROM segments GROUP BY segment"),
)
def segment_distribution(spark, sf_dir):
    return reporting.segment_distribution(_segments(spark, sf_dir))


# ---------------------------------------------------------------- recommendations


@register(
    "user_destinations",
    sql.query(EV, sql.AFFINITY, final="SELECT user_id, destination, signal_strength FROM affinity"),
)
def user_destinations(spark, sf_dir):
    return _affinity(spark, sf_dir)


@register(
    "user_similarity",
    sql.query(
        EV, sql.AFFINITY, sql.SIMILARITY,
        final="""SELECT ua AS user_id, count(*) AS similar_users,
        round(sum(likeness), 6) AS similarity_total FROM likeness GROUP BY ua""",
    ),
)
def user_similarity(spark, sf_dir):
    return recommendations.user_similarity(_affinity(spark, sf_dir))


@register(
    "recommendation_candidates",
    sql.query(
        EV, *sql.CF[:3],
        final="""SELECT user_id, destination, round(raw_score, 6) AS raw_score, supporting_users
        FROM candidates""",
    ),
)
def recommendation_candidates(spark, sf_dir):
    return recommendations.recommendation_candidates(_affinity(spark, sf_dir))


RECOMMENDATION_COLUMNS = (
    "user_id recommended_destination recommendation_score:num supporting_users rank:int generated_at:ts"
)


@register("recommend_user_cf", sql.query(EV, *sql.CF, final=select(RECOMMENDATION_COLUMNS, "recommendations")))
def recommend_user_cf(spark, sf_dir):
    return _recommendations(spark, sf_dir)


# ---------------------------------------------------------------- activation

CRM = (
    "user_id segment engagement_score lifetime_revenue:num lifetime_conversions:int primary_platform "
    "primary_country first_seen_at:ts last_seen_at:ts synced_at:ts previous_segment segment_changed_at:ts"
)
TWO_SYNCS = (
    EV,
    sql.sessions("sessions_old", EARLIER),
    sql.users("users_old", "sessions_old", EARLIER),
    sql.segments("old", "users_old", EARLIER, EARLIER),
    sql.sessions(),
    sql.users(),
    sql.segments("new"),
)


def _merged_sql(updated: tuple[str, ...], tracked: bool) -> str:
    picks = [
        f"CASE WHEN n.user_id IS NOT NULL THEN n.{c} ELSE o.{c} END AS {c}"
        if c in updated
        else f"CASE WHEN o.user_id IS NOT NULL THEN o.{c} ELSE n.{c} END AS {c}"
        for c in activation.CRM_ATTRIBUTES
    ]
    previous = "o.segment" if tracked else "NULL::VARCHAR"
    changed = f"CASE WHEN o.segment <> n.segment THEN {sql.ts(AS_OF)} END" if tracked else "NULL::TIMESTAMP"
    return f"""
merged AS (
  SELECT coalesce(n.user_id, o.user_id) AS user_id, {', '.join(picks)},
    CASE WHEN n.user_id IS NOT NULL THEN {sql.ts(AS_OF)} ELSE {sql.ts(EARLIER)} END AS synced_at,
    CASE WHEN n.user_id IS NOT NULL THEN {previous} END AS previous_segment,
    {changed} AS segment_changed_at
  FROM old o FULL JOIN new n ON o.user_id = n.user_id)"""


def _crm_after_first_sync(spark, sf_dir) -> DataFrame:
    empty = spark.createDataFrame([], activation.CRM_SCHEMA)
    return activation.merge_segments(empty, _segments(spark, sf_dir, EARLIER), EARLIER)


@register(
    "merge_segments",
    sql.query(*TWO_SYNCS, _merged_sql(activation.CRM_ATTRIBUTES, True), final=select(CRM, "merged")),
)
def merge_segments(spark, sf_dir):
    current = _crm_after_first_sync(spark, sf_dir)
    return activation.merge_segments(current, _segments(spark, sf_dir), AS_OF)


@register(
    "merge_segments_reduced",
    sql.query(*TWO_SYNCS, _merged_sql(activation.REDUCED_ATTRIBUTES, False), final=select(CRM, "merged")),
)
def merge_segments_reduced(spark, sf_dir):
    current = _crm_after_first_sync(spark, sf_dir)
    return activation.merge_segments(current, _segments(spark, sf_dir), AS_OF, track_changes=False)


_DIFFERS = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in activation.CRM_ATTRIBUTES)


@register(
    "merge_metrics",
    sql.query(
        *TWO_SYNCS,
        final=f"""SELECT count(*) AS rows_extracted,
        count(*) FILTER (WHERE o.user_id IS NULL OR {_DIFFERS}) AS rows_upserted,
        count(*) FILTER (WHERE o.user_id IS NULL) AS rows_inserted,
        count(*) FILTER (WHERE o.user_id IS NOT NULL AND ({_DIFFERS})) AS rows_updated,
        count(*) FILTER (WHERE o.user_id IS NOT NULL AND NOT ({_DIFFERS})) AS rows_unchanged
        FROM new n LEFT JOIN old o ON o.user_id = n.user_id""",
    ),
)
def merge_metrics(spark, sf_dir):
    return activation.merge_metrics(
        _crm_after_first_sync(spark, sf_dir), _segments(spark, sf_dir)
    )


ABANDONED = f"""
pairs AS (
  SELECT user_id, search_query AS last_search_query, max(event_timestamp) AS last_search_time,
    count(*) AS search_count
  FROM searches WHERE user_id IS NOT NULL AND event_timestamp >= {sql.ts(AS_OF)} - INTERVAL 48 HOUR
   AND user_id NOT IN (SELECT user_id FROM conversions WHERE user_id IS NOT NULL
                       AND event_timestamp >= {sql.ts(AS_OF)} - INTERVAL 48 HOUR)
  GROUP BY ALL HAVING max(event_timestamp) >= {sql.ts(AS_OF)} - INTERVAL 24 HOUR),
abandoned AS (SELECT * FROM pairs)"""


def _abandoned(spark, sf_dir) -> DataFrame:
    searches, _, conversions = inputs.all_staged(spark, sf_dir)
    return activation.abandoned_searches(searches, conversions, AS_OF)


@register(
    "abandoned_searches",
    sql.query(EV, ABANDONED, final=select("user_id last_search_query last_search_time:ts search_count", "abandoned")),
)
def abandoned_searches(spark, sf_dir):
    return _abandoned(spark, sf_dir)


QUEUE = f"""
queue AS (
  SELECT 'user_' || user_id AS user_id, ts AS created_at,
    CASE event_type WHEN 'signup' THEN 'pending' WHEN 'error' THEN 'failed' WHEN 'view' THEN 'sent'
                    ELSE 'processing' END AS status
  FROM events WHERE ts < {sql.ts('2024-01-30 12:00:00')})"""


@register(
    "queue_emails",
    sql.query(
        EV, ABANDONED, QUEUE,
        final=f"""SELECT user_id, 'abandoned_search' AS email_template,
        '{{"search_query":"' || last_search_query || '","search_count":' || search_count ||
        ',"personalized_link":"/search?q=' || last_search_query || '"}}' AS payload,
        3 AS priority, 'pending' AS status, '{AS_OF}.000000' AS created_at
        FROM (SELECT * FROM abandoned QUALIFY row_number() OVER (PARTITION BY user_id
              ORDER BY last_search_time DESC, last_search_query) = 1)
        WHERE user_id NOT IN (SELECT user_id FROM queue WHERE status IN ('pending', 'sent')
              AND created_at >= {sql.ts(AS_OF)} - INTERVAL 24 HOUR)""",
    ),
)
def queue_emails(spark, sf_dir):
    """The queue holds a mail per event up to half a day before the clock."""
    status = (
        F.when(F.col("event_type") == "signup", "pending")
        .when(F.col("event_type") == "error", "failed")
        .when(F.col("event_type") == "view", "sent")
        .otherwise("processing")
    )
    queue = (
        read_table(spark, sf_dir, "events")
        .filter(F.col("ts") < F.lit("2024-01-30 12:00:00").cast("timestamp"))
        .select(
            F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user_id"),
            F.lit(activation.EMAIL_TEMPLATE).alias("email_template"),
            F.col("ts").alias("created_at"),
            status.alias("status"),
        )
    )
    return activation.queue_emails(_abandoned(spark, sf_dir), queue, AS_OF).drop("processed_at")


KV = """
kv AS (
  SELECT 'reco:' || user_id AS "key",
    string_agg(recommended_destination || '=' || CAST(recommendation_score AS DOUBLE), ','
               ORDER BY recommended_destination) AS "value",
    TIMESTAMP '2024-02-07 00:00:00' AS expires_at
  FROM recommendations WHERE recommendation_score > 0.5 AND rank <= 10 GROUP BY user_id)"""


@register("export_reco_kv", sql.query(EV, *sql.CF, KV, final=select("key value expires_at:ts", "kv")))
def export_reco_kv(spark, sf_dir):
    kv = activation.export_reco_kv(_recommendations(spark, sf_dir), as_of=AS_OF)
    entries = F.transform(
        F.array_sort(F.map_entries("value")),
        lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")),
    )
    return kv.withColumn("value", F.array_join(entries, ","))


@register(
    "lookup_reco",
    sql.query(
        EV, *sql.CF,
        final="""SELECT recommended_destination AS destination, recommendation_score AS score
        FROM recommendations WHERE user_id = 'user_1' AND recommendation_score > 0.5""",
    ),
)
def lookup_reco(spark, sf_dir):
    """Writes the whole key-value export and looks one user up in the stored table."""
    path = scratch_path(spark, "kv")
    activation.write_kv(activation.export_reco_kv(_recommendations(spark, sf_dir), as_of=AS_OF), path)
    return activation.lookup_reco(spark.read.parquet(path), "user_1", as_of=AS_OF)


@register(
    "changed_since",
    sql.query(
        *SEGMENTS,
        final=select("user_id segment last_seen_at:ts", f"segments WHERE last_seen_at > {sql.ts(EARLIER)}"),
    ),
)
def changed_since(spark, sf_dir):
    changed = activation.changed_since(_segments(spark, sf_dir), "last_seen_at", EARLIER)
    return changed.select("user_id", "segment", "last_seen_at")


_RECONCILED = ("segment", "engagement_score", "lifetime_conversions")


@register(
    "reconcile",
    sql.query(
        *TWO_SYNCS,
        final=f"""SELECT * FROM (SELECT coalesce(n.user_id, o.user_id) AS user_id,
        CASE WHEN o.user_id IS NULL THEN 'missing_in_destination'
             WHEN n.user_id IS NULL THEN 'missing_in_mart'
             WHEN {' OR '.join(f'n.{c} IS DISTINCT FROM o.{c}' for c in _RECONCILED)}
             THEN 'different' END AS drift,
        CASE WHEN o.user_id IS NOT NULL AND n.user_id IS NOT NULL THEN
          concat_ws(',', {', '.join(f"CASE WHEN n.{c} IS DISTINCT FROM o.{c} THEN '{c}' END" for c in _RECONCILED)})
        END AS columns
        FROM new n FULL JOIN old o ON o.user_id = n.user_id) WHERE drift IS NOT NULL""",
    ),
)
def reconcile(spark, sf_dir):
    mart = _segments(spark, sf_dir)
    return activation.reconcile(mart, _crm_after_first_sync(spark, sf_dir), ["user_id"], _RECONCILED)


@register("materialize_incremental", sql.query(*FUNNEL, final=select(FUNNEL_COLUMNS, "funnel")))
def materialize_incremental(spark, sf_dir):
    """A run when only the first two weeks were known, then a run over everything."""
    path = scratch_path(spark, "funnel")
    known = _sessions(spark, sf_dir)
    early = known.filter(F.col("session_start") < F.lit("2024-01-15 00:00:00").cast("timestamp"))
    activation.materialize_incremental(spark, early, marts.search_funnel, path)
    stored = activation.materialize_incremental(spark, known, marts.search_funnel, path)
    return stored.select(*_funnel(spark, sf_dir).columns)


@register("refresh_late_days", sql.query(*FUNNEL, final=select(FUNNEL_COLUMNS, "funnel")))
def refresh_late_days(spark, sf_dir):
    """A ninth of all events arrives long after the rest, and only the days it touches are built again."""
    path = scratch_path(spark, "late-days")
    arrival = F.lit("2024-06-01 00:00:00").cast("timestamp")
    late = F.pmod(F.xxhash64("event_id"), F.lit(9)) == 0
    parts = [
        p.withColumn("ingested_at", F.when(late, arrival).otherwise(F.col("ingested_at")))
        for p in inputs.all_staged(spark, sf_dir)
    ]
    early = sessions.search_sessions(*[p.filter(~late) for p in parts])
    activation.materialize_days(spark, early, None, marts.search_funnel, path)
    days = activation.touched_days(parts[0], parts[1:], "2024-06-01 00:00:00")
    stored = activation.materialize_days(
        spark, sessions.search_sessions(*parts), days, marts.search_funnel, path
    )
    return stored.select(*_funnel(spark, sf_dir).columns)


@register(
    "write_events",
    sql.query(
        EV,
        final="""SELECT event_type, count(*) AS events, count(user_id) AS known FROM (
        SELECT event_type, user_id FROM searches UNION ALL SELECT event_type, user_id FROM clicks
        UNION ALL SELECT event_type, user_id FROM conversions) GROUP BY event_type""",
    ),
)
def write_events(spark, sf_dir):
    """All events to the per-type JSON sink; counted from the files."""
    path = scratch_path(spark, "events")
    doc = F.from_json("line", "event_id STRING, event_type STRING, user_id STRING, session_id STRING")
    activation.write_events(_feed_lines(spark, sf_dir).select(doc.alias("d")).select("d.*"), path)
    stored = spark.read.schema("event_id STRING, user_id STRING, event_type STRING").json(path)
    return stored.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.count("user_id").alias("known")
    )


@register(
    "fan_out",
    sql.query(
        *SEGMENTS,
        final="""SELECT sink, count(*) AS users, CAST(sum(engagement_score) AS BIGINT) AS points
        FROM segments CROSS JOIN (VALUES ('json'), ('parquet')) v(sink) GROUP BY sink""",
    ),
)
def fan_out(spark, sf_dir):
    """Segments to a Parquet and a JSON sink, read back from both."""
    paths = {kind: scratch_path(spark, f"fan-{kind}") for kind in ("parquet", "json")}
    activation.fan_out(
        _segments(spark, sf_dir),
        [lambda df: df.write.parquet(paths["parquet"]), lambda df: df.write.json(paths["json"])],
    )
    read = [
        spark.read.schema("user_id STRING, engagement_score INT").format(kind).load(path).select(
            F.lit(kind).alias("sink"), "engagement_score"
        )
        for kind, path in paths.items()
    ]
    return read[0].unionByName(read[1]).groupBy("sink").agg(
        F.count(F.lit(1)).alias("users"), F.sum("engagement_score").alias("points")
    )


# ---------------------------------------------------------------- quality


def _quality_models(spark, sf_dir) -> dict[str, Callable[[], DataFrame]]:
    built = {
        "int_search_sessions": lambda: _sessions(spark, sf_dir),
        "int_user_journeys": lambda: _journeys(spark, sf_dir),
        "fct_search_funnel": lambda: _funnel(spark, sf_dir),
        "dim_users": lambda: _users(spark, sf_dir),
        "mart_user_segments": lambda: _segments(spark, sf_dir),
        "mart_recommendations": lambda: _recommendations(spark, sf_dir),
    }
    models = {
        name: lambda name=name: inputs.model(spark, sf_dir, name, built[name]) for name in built
    }
    for kind in inputs.KINDS:
        models[f"raw_{kind}_events"] = lambda kind=kind: inputs.raw(spark, sf_dir, kind)
        models[f"stg_{kind}_events"] = lambda kind=kind: inputs.staged(spark, sf_dir, kind)
    return models


QUALITY_TABLES = {
    "raw_search_events": "(SELECT *, 'document' AS payload FROM searches)",
    "raw_click_events": "(SELECT *, 'document' AS payload FROM clicks)",
    "raw_conversion_events": "(SELECT *, 'document' AS payload FROM conversions)",
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


def _rule_sql(model: str, rule: quality.Rule) -> str:
    table = QUALITY_TABLES[model]
    column = rule.columns[0] if rule.columns else ""
    if rule.kind.startswith("unique"):
        cols = ", ".join(rule.columns)
        present = f"WHERE {column} IS NOT NULL" if len(rule.columns) == 1 else ""
        count = f"(SELECT count(*) FROM (SELECT 1 FROM {table} {present} GROUP BY {cols} HAVING count(*) > 1))"
    else:
        broken = {
            "not_null": f"{column} IS NULL",
            "accepted_values": f"{column} NOT IN ({', '.join(map(repr, rule.values))})",
            "accepted_range": " OR ".join(
                part for part, bound in (
                    (f"{column} < {rule.low}", rule.low), (f"{column} > {rule.high}", rule.high)
                ) if bound is not None
            ),
            "expression_is_true": f"NOT ({rule.expression})",
        }[rule.kind]
        where = f" AND ({rule.where})" if rule.where else ""
        count = f"(SELECT count(*) FROM {table} WHERE ({broken}){where})"
    name = rule.name.replace("'", "''")
    return f"SELECT '{name}' AS test_name, '{model}' AS model, {count} AS failures"


def _quality_sql(models) -> str:
    tests = " UNION ALL ".join(_rule_sql(m, r) for m in models for r in rules.RULES[m])
    return f"""SELECT test_name, model, CASE WHEN failures = 0 THEN 'pass' ELSE 'warn' END AS status,
      failures, CASE WHEN failures > 0 THEN failures || ' failures' END AS message FROM ({tests})"""


ALL_MODELS = (*sql.MODELS, *sql.CF)


def _results(spark, sf_dir, models) -> DataFrame:
    tables = _quality_models(spark, sf_dir)
    parts = [quality.run_quality(tables[m](), m, rules.RULES[m]) for m in models]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _register_quality(name: str, models: tuple[str, ...]) -> None:
    @register(f"quality_{name}", sql.query(*ALL_MODELS, final=_quality_sql(models)))
    def run(spark, sf_dir):
        return _results(spark, sf_dir, models)


RAW_AND_STAGING = tuple(m for m in rules.RULES if m[:3] in ("raw", "stg"))
INTERMEDIATE = ("int_search_sessions", "int_user_journeys")
MARTS = ("fct_search_funnel", "dim_users", "mart_user_segments", "mart_recommendations")
_register_quality("staging", RAW_AND_STAGING)
_register_quality("intermediate", INTERMEDIATE)
_register_quality("marts", MARTS)


@register(
    "quality_summary",
    sql.query(
        *ALL_MODELS,
        final=f"""SELECT count(*) AS tests, count(*) FILTER (WHERE status = 'pass') AS passed,
        count(*) FILTER (WHERE status = 'warn') AS warned, count(*) FILTER (WHERE status = 'fail') AS failed,
        round(count(*) FILTER (WHERE status = 'pass') * 100.0::DOUBLE / count(*), 6) AS pass_rate
        FROM ({_quality_sql(tuple(rules.RULES))})""",
    ),
)
def quality_summary(spark, sf_dir):
    return quality.quality_summary(_results(spark, sf_dir, tuple(rules.RULES)))


@register(
    "quality_failing_rows",
    sql.query(*SESSIONS, final="SELECT session_id, round(session_ctr, 6) AS session_ctr FROM sessions WHERE session_ctr > 1"),
)
def quality_failing_rows(spark, sf_dir):
    rule = quality.accepted_range("session_ctr", 0, 1)
    return quality.failing_rows(_sessions(spark, sf_dir), rule).select("session_id", "session_ctr")


@register(
    "quality_duplicates",
    sql.query(EV, final="SELECT session_id, count(*) AS copies FROM clicks GROUP BY session_id HAVING count(*) > 1"),
)
def quality_duplicates(spark, sf_dir):
    """Sessions with several clicks, found by the uniqueness rule."""
    return quality.failing_rows(inputs.staged(spark, sf_dir, "click"), quality.unique("session_id"))


_AGE = f"(epoch_us({sql.ts(AS_OF)}) - epoch_us(max(ingested_at))) / 1000000.0::DOUBLE / 3600"


@register(
    "freshness",
    sql.query(
        EV,
        final=" UNION ALL ".join(
            f"""SELECT 'freshness: ingested_at' AS test_name, 'raw_{kind}_events' AS model,
            CASE WHEN age <= {warn} THEN 'pass' WHEN age <= {error} THEN 'warn' ELSE 'fail' END AS status,
            round(age, 6) AS age_hours FROM (SELECT {_AGE} AS age FROM {table})"""
            for kind, table, (warn, error) in (
                ("search", "searches", (1, 6)), ("click", "clicks", (1, 6)),
                ("conversion", "conversions", (2, 12)),
            )
        ),
    ),
)
def freshness(spark, sf_dir):
    parts = [
        quality.freshness(
            inputs.raw(spark, sf_dir, kind), f"raw_{kind}_events", "ingested_at",
            *rules.FRESHNESS_HOURS[f"raw_{kind}_events"], as_of=AS_OF,
        )
        for kind in inputs.KINDS
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register(
    "relationships",
    """SELECT 'relationships: l_orderkey' AS test_name, 'lineitem' AS model,
    CASE WHEN failures = 0 THEN 'pass' ELSE 'warn' END AS status, failures,
    CASE WHEN failures > 0 THEN failures || ' failures' END AS message
    FROM (SELECT count(*) AS failures FROM lineitem WHERE l_orderkey NOT IN (
      SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'))""",
)
def relationships(spark, sf_dir):
    """Line items whose order is not a finished one."""
    finished = read_table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    return quality.relationships(
        read_table(spark, sf_dir, "lineitem"), "l_orderkey", finished, "o_orderkey", "lineitem"
    )


from registry import model_checks, more_queries  # noqa: E402,F401  (register the rest)

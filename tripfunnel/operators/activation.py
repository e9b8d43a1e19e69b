"""Activation: merges, key-value export, email queue, extracts, reconciliation, logs."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripfunnel.functions.scalar import clock, hours_before
from tripfunnel.operators.rows import first_per_group
from tripfunnel.plans.marts import recent_users
from tripfunnel.session import remove_folder, scratch_path

CRM_ATTRIBUTES = (
    "segment",
    "engagement_score",
    "lifetime_revenue",
    "lifetime_conversions",
    "primary_platform",
    "primary_country",
    "first_seen_at",
    "last_seen_at",
)
REDUCED_ATTRIBUTES = CRM_ATTRIBUTES[:4]

CRM_SCHEMA = (
    "user_id string, segment string, engagement_score int, lifetime_revenue decimal(12,2), "
    "lifetime_conversions int, primary_platform string, primary_country string, "
    "first_seen_at timestamp, last_seen_at timestamp, synced_at timestamp, "
    "previous_segment string, segment_changed_at timestamp"
)
_CRM_TYPES = dict(part.split(" ") for part in CRM_SCHEMA.replace("12,2", "12;2").split(", "))


def _crm_type(name: str) -> str:
    return _CRM_TYPES[name].replace(";", ",")


def extract_segments(segments: DataFrame, limit: int | None = None) -> DataFrame:
    """The CRM columns of known users, smallest user ids first when limited."""
    known = segments.filter(F.col("user_id").isNotNull()).select(
        "user_id", *[F.col(c).cast(_crm_type(c)).alias(c) for c in CRM_ATTRIBUTES]
    )
    return known if limit is None else known.orderBy("user_id").limit(limit)


def merge_segments(
    current: DataFrame,
    incoming: DataFrame,
    as_of=None,
    track_changes: bool = True,
    only_on_change: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """The CRM snapshot after an upsert of ``incoming``; write it to a new path.

    A matched row takes the incoming attributes; ``previous_segment`` becomes the
    segment it had before, and ``segment_changed_at`` moves only when the segment
    differs. ``track_changes=False`` updates segment, score, revenue and conversions
    only; ``only_on_change`` keeps ``previous_segment`` while the segment stays.
    """
    now = clock(as_of)
    updated = CRM_ATTRIBUTES if track_changes else REDUCED_ATTRIBUTES
    old = current.select(F.struct(*current.columns).alias("old"), "user_id")
    new = extract_segments(incoming, limit)
    new = new.select(F.struct(*new.columns).alias("new"), "user_id")
    matched = F.col("old").isNotNull() & F.col("new").isNotNull()
    arrived = F.col("new").isNotNull()
    differs = F.col("old.segment") != F.col("new.segment")

    def attribute(name: str) -> Column:
        if name in updated:
            return F.when(arrived, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}"))
        return F.when(F.col("old").isNotNull(), F.col(f"old.{name}")).otherwise(F.col(f"new.{name}"))

    replaced = matched & differs if only_on_change else matched
    if not track_changes:
        replaced = F.lit(False)
    changed = matched & differs if track_changes else F.lit(False)
    return old.join(new, "user_id", "full_outer").select(
        "user_id",
        *[attribute(c).cast(_crm_type(c)).alias(c) for c in CRM_ATTRIBUTES],
        F.when(arrived, now).otherwise(F.col("old.synced_at")).alias("synced_at"),
        F.when(replaced, F.col("old.segment"))
        .otherwise(F.col("old.previous_segment"))
        .alias("previous_segment"),
        F.when(changed, now).otherwise(F.col("old.segment_changed_at")).alias("segment_changed_at"),
    )


def _same(columns: Sequence[str], left: str, right: str) -> Column:
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return same


def merge_metrics(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Rows extracted, inserted, updated and left equal, by comparing values."""
    old = current.select(F.struct(*CRM_ATTRIBUTES).alias("old"), "user_id")
    new = extract_segments(incoming)
    new = new.select(F.struct(*CRM_ATTRIBUTES).alias("new"), "user_id")
    known = F.col("old").isNotNull()
    same = _same(CRM_ATTRIBUTES, "old", "new")
    return new.join(old, "user_id", "left").agg(
        F.count(F.lit(1)).alias("rows_extracted"),
        F.count_if(~known | ~same).alias("rows_upserted"),
        F.count_if(~known).alias("rows_inserted"),
        F.count_if(known & ~same).alias("rows_updated"),
        F.count_if(known & same).alias("rows_unchanged"),
    )


def abandoned_searches(
    searches: DataFrame,
    conversions: DataFrame,
    as_of=None,
    search_hours: float = 48,
    fresh_hours: float = 24,
    limit: int | None = None,
) -> DataFrame:
    """(user, query) pairs searched lately by users who did not convert; with ``limit`` only the newest.

    Searches are rolled up before the anti join, which then sees one row per pair.
    """
    now = clock(as_of)
    pairs = (
        searches.filter(F.col("user_id").isNotNull())
        .filter(F.col("event_timestamp") >= hours_before(now, search_hours))
        .groupBy("user_id", F.col("search_query").alias("last_search_query"))
        .agg(
            F.max("event_timestamp").alias("last_search_time"),
            F.count(F.lit(1)).alias("search_count"),
        )
        .filter(F.col("last_search_time") >= hours_before(now, fresh_hours))
    )
    open_pairs = pairs.join(recent_users(conversions, as_of, search_hours), "user_id", "left_anti")
    if limit is None:
        return open_pairs
    return open_pairs.orderBy(
        F.col("last_search_time").desc(), "user_id", F.col("last_search_query").asc_nulls_last()
    ).limit(limit)


EMAIL_TEMPLATE = "abandoned_search"


def queue_emails(
    candidates: DataFrame, queue: DataFrame, as_of=None, cooldown_hours: float = 24
) -> DataFrame:
    """Queue rows to append: the newest pair per user, unless a mail of this kind is
    pending or was sent within the cool-down.
    """
    now = clock(as_of)
    blocked = (
        queue.filter(F.col("email_template") == EMAIL_TEMPLATE)
        .filter(F.col("created_at") >= hours_before(now, cooldown_hours))
        .filter(F.col("status").isin("pending", "sent"))
        .select("user_id")
        .distinct()
    )
    newest = first_per_group(
        candidates,
        ["user_id"],
        [F.col("last_search_time").desc(), F.col("last_search_query").asc_nulls_last()],
    )
    payload = F.struct(
        F.col("last_search_query").alias("search_query"),
        "search_count",
        F.concat(F.lit("/search?q="), F.col("last_search_query")).alias("personalized_link"),
    )
    return newest.join(blocked, "user_id", "left_anti").select(
        "user_id",
        F.lit(EMAIL_TEMPLATE).alias("email_template"),
        F.to_json(payload).alias("payload"),
        F.lit(3).alias("priority"),
        F.lit("pending").alias("status"),
        now.alias("created_at"),
        F.lit(None).cast("timestamp").alias("processed_at"),
    )


def export_reco_kv(
    recommendations: DataFrame,
    prefix: str = "reco:",
    min_score: float = 0.5,
    max_rank: int = 10,
    ttl_days: int = 7,
    as_of=None,
) -> DataFrame:
    """``(key, value, expires_at)`` with one destination → score map per user.

    Ranks are capped per user, so a map holds at most ``max_rank`` entries.
    """
    entries = F.sort_array(
        F.collect_list(F.struct("recommended_destination", "recommendation_score"))
    )
    return (
        recommendations.filter(
            (F.col("recommendation_score") > min_score) & (F.col("rank") <= max_rank)
        )
        .groupBy("user_id")
        .agg(F.map_from_entries(entries).alias("value"))
        .select(
            F.concat(F.lit(prefix), F.col("user_id")).alias("key"),
            "value",
            (clock(as_of) + F.make_dt_interval(days=F.lit(ttl_days))).alias("expires_at"),
        )
    )


def write_kv(kv: DataFrame, path: str) -> None:
    """Stored in ranges of the key, sorted inside: a lookup reads one row group by its bounds."""
    kv.repartitionByRange("key").sortWithinPartitions("key").write.mode("overwrite").parquet(path)


def lookup_reco(kv: DataFrame, user_id: str, prefix: str = "reco:", as_of=None) -> DataFrame:
    """The live entries of one user; the key filter reaches the Parquet scan."""
    live = kv.filter(F.col("key") == f"{prefix}{user_id}").filter(
        F.col("expires_at") > clock(as_of)
    )
    return live.select(F.explode("value").alias("destination", "score"))


def reco_extract(recommendations: DataFrame) -> DataFrame:
    """Recommendations in the order the sync reads them: by user, then rank. Sorted by sampled ranges,
    so that files follow one another and none holds more than its share.
    """
    return recommendations.orderBy("user_id", "rank").select(
        "user_id", "recommended_destination", "recommendation_score", "rank"
    )


def changed_since(df: DataFrame, ts: str, high_water_mark) -> DataFrame:
    """Rows newer than the last sync; without a mark, every row."""
    if high_water_mark is None:
        return df
    return df.filter(F.col(ts) > clock(high_water_mark))


def reconcile(
    mart: DataFrame, destination: DataFrame, key: Sequence[str], columns: Sequence[str], buckets: int = 4096
) -> DataFrame:
    """Keys on which the destination drifted from the mart, with the kind of drift.

    Both sides are cut into buckets by the hash of the key, and each bucket is digested where it lies.
    Only rows of buckets whose digests differ are shuffled and compared. A digest is the row count and
    two exact sums of 64-bit hashes with different seeds, over values and which of them are null; equal
    digests of different buckets are as good as impossible. Columns of different types on the two sides
    hash differently: then all is compared. Null keys match nothing and drift on either side; other keys
    are unique on each side.
    """
    names = [*key, *columns]

    def bucketed(df: DataFrame) -> DataFrame:
        return df.select(*names, F.pmod(F.xxhash64(*key), F.lit(buckets)).alias("_bucket"))

    def digests(df: DataFrame, side: str) -> DataFrame:
        nulls = [F.col(c).isNull() for c in names]
        sums = [F.sum(F.xxhash64(F.lit(seed), *names, *nulls).cast("decimal(20,0)")) for seed in (1, 2)]
        keyless = F.bool_or(reduce(or_, nulls[: len(key)]))
        return df.groupBy("_bucket").agg(
            F.struct(F.count(F.lit(1)), *sums).alias(side), keyless.alias(f"{side}_keyless")
        )

    ours, theirs = bucketed(mart), bucketed(destination)
    keyless = F.coalesce("l_keyless", F.lit(False)) | F.coalesce("r_keyless", F.lit(False))
    differing = (
        digests(ours, "l")
        .join(digests(theirs, "r"), "_bucket", "full_outer")
        .filter(~F.col("l").eqNullSafe(F.col("r")) | keyless)
        .select("_bucket")
    )

    def suspects(df: DataFrame, side: str) -> DataFrame:
        # At most one number a bucket: small whatever the tables are.
        rows = df.join(F.broadcast(differing), "_bucket", "left_semi")
        return rows.select(*key, F.struct(*columns).alias(side))

    both = F.col("ours").isNotNull() & F.col("theirs").isNotNull()
    drifted = F.filter(
        F.array(
            *[
                F.when(~F.col(f"ours.{c}").eqNullSafe(F.col(f"theirs.{c}")), F.lit(c))
                for c in columns
            ]
        ),
        lambda name: name.isNotNull(),
    )
    return (
        suspects(ours, "ours").join(suspects(theirs, "theirs"), list(key), "full_outer")
        .withColumn("_drifted", F.when(both, drifted))
        .select(
            *key,
            F.when(F.col("theirs").isNull(), "missing_in_destination")
            .when(F.col("ours").isNull(), "missing_in_mart")
            .when(F.size("_drifted") > 0, "different")
            .alias("drift"),
            F.array_join("_drifted", ",").alias("columns"),
        )
        .filter(F.col("drift").isNotNull())
    )


def write_events(events: DataFrame, path: str, mode: str = "append") -> None:
    """JSON lines, one folder per ``event_type``."""
    events.write.mode(mode).partitionBy("event_type").json(path)


def fan_out(df: DataFrame, sinks: Sequence[Callable[[DataFrame], None]]) -> None:
    """Writes the same rows to every sink, computing them once: into a table in the shared
    folder, so that a lost executor costs nothing.
    """
    path = scratch_path(df.sparkSession, "fan-out")
    df.write.parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    for sink in sinks:
        sink(kept)


def materialize_incremental(
    spark, sessions: DataFrame, build: Callable[[DataFrame], DataFrame], path: str,
    date_column: str = "funnel_date", ts: str = "session_start", lookback_days: int = 1,
) -> DataFrame:
    """Recomputes from the last stored day minus the lookback and replaces those days.

    Only the days in the new result are overwritten (dynamic partition overwrite). The
    first run, without a stored table, builds everything.
    """
    from pyspark.errors import AnalysisException

    try:
        last = spark.read.parquet(path).agg(F.max(date_column)).first()[0]
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        last = None
    if last is not None:
        start = F.date_sub(F.lit(last).cast("date"), lookback_days)
        sessions = sessions.filter(F.to_date(ts) >= start)
    (
        build(sessions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date_column)
        .parquet(path)
    )
    return spark.read.parquet(path)


def touched_days(
    openings: DataFrame, others: Sequence[DataFrame], since, session: str = "session_id",
    ts: str = "event_timestamp", ingested: str = "ingested_at",
) -> DataFrame:
    """Days (``day``, distinct, null included) whose sessions may differ since ``since``.

    A session opens on the day of its first event in ``openings``. It is touched by an event of any of
    the tables ingested at ``since`` or later, and counts for the day on which it opens now and the one
    on which it opened without those events. Events without a session form one session, as in the
    session model. Stored events never change, as ingest appends unknown ids only.
    """
    fresh = F.coalesce(F.col(ingested) >= clock(since), F.lit(False))
    arrived = [df.filter(fresh).select(F.col(session).alias("_touched")) for df in (openings, *others)]
    touched = reduce(DataFrame.unionByName, arrived).distinct()
    opened = openings.join(touched, F.col(session).eqNullSafe(F.col("_touched")), "left_semi")
    days = opened.groupBy(session).agg(
        F.min(ts).alias("now"), F.min(F.when(~fresh, F.col(ts))).alias("before")
    )
    return days.select(F.explode(F.array(F.to_date("now"), F.to_date("before"))).alias("day")).distinct()


def materialize_days(
    spark, sessions: DataFrame, days: DataFrame | None, build: Callable[[DataFrame], DataFrame], path: str,
    date_column: str = "funnel_date", ts: str = "session_start",
) -> DataFrame:
    """Builds the given days again and replaces them; no other day is read into the build or rewritten.

    A day that has no session any more loses its partition. Without ``days`` everything is built.
    """
    if days is not None:
        named = days.select(F.col("day").alias("_day"))
        sessions = sessions.join(named, F.to_date(ts).eqNullSafe(F.col("_day")), "left_semi")
    built = build(sessions)
    (
        built.write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if days is None else "dynamic")
        .partitionBy(date_column)
        .parquet(path)
    )
    if days is not None:
        left = sessions.select(F.to_date(ts).alias("_day")).distinct()
        gone = named.join(left, named["_day"].eqNullSafe(left["_day"]), "left_anti")
        for row in gone.collect():  # days of the calendar, not rows
            day = "__HIVE_DEFAULT_PARTITION__" if row["_day"] is None else row["_day"].isoformat()
            remove_folder(spark, f"{path}/{date_column}={day}")
    return spark.read.schema(built.schema).parquet(path)


SYNC_LOG_SCHEMA = (
    "sync_id string, sync_type string, source_table string, destination string, "
    "started_at timestamp, completed_at timestamp, rows_extracted long, rows_upserted long, "
    "rows_unchanged long, error_message string, high_water_mark timestamp"
)
RUN_LOG_SCHEMA = (
    "run_id string, dag_id string, run_type string, started_at timestamp, "
    "completed_at timestamp, status string, rows_processed long, error_message string"
)


def log_run(spark, row: dict, path: str, schema: str = RUN_LOG_SCHEMA) -> None:
    """Appends one run to a log table; absent fields are null."""
    names = [part.split(" ")[0] for part in schema.split(", ")]
    values = tuple(row.get(name) for name in names)
    spark.createDataFrame([values], schema).coalesce(1).write.mode("append").parquet(path)

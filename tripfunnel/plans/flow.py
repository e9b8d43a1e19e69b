"""The full run: raw tables → staging → sessions and journeys → marts → syncs."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping
from datetime import datetime, timezone

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripfunnel.operators import activation, quality, reporting, staging
from tripfunnel.operators.activation import RUN_LOG_SCHEMA, SYNC_LOG_SCHEMA, log_run
from tripfunnel.operators.journeys import user_journeys
from tripfunnel.operators.sessions import search_sessions
from tripfunnel.plans import marts, recommendations
from tripfunnel.plans.rules import FRESHNESS_HOURS, RULES
from tripfunnel.sources import raw
from tripfunnel.sources.catalog import Catalog
from tripfunnel.sources.id_index import IdIndex

RAW = {
    "search": "raw.search_events",
    "click": "raw.click_events",
    "conversion": "raw.conversion_events",
}

# Logical name of every stored model, by the name its rules use.
MODELS = {
    "raw_search_events": "raw.search_events",
    "raw_click_events": "raw.click_events",
    "raw_conversion_events": "raw.conversion_events",
    "stg_search_events": "staging.stg_search_events",
    "stg_click_events": "staging.stg_click_events",
    "stg_conversion_events": "staging.stg_conversion_events",
    "int_search_sessions": "intermediate.int_search_sessions",
    "int_user_journeys": "intermediate.int_user_journeys",
    "fct_search_funnel": "analytics.fct_search_funnel",
    "dim_users": "analytics.dim_users",
    "mart_user_segments": "marketing.mart_user_segments",
    "mart_recommendations": "marketing.mart_recommendations",
}


RAW_SCHEMA = (
    "event_id string, payload string, ingested_at timestamp, source_file string, batch_id string"
)
QUEUE_SCHEMA = (
    "user_id string, email_template string, payload string, priority int, status string, "
    "created_at timestamp, processed_at timestamp"
)
INGEST_LOG = "ops.ingest_log"
BUILD_MARKS = "ops.build_marks"
MARK_SCHEMA = "model string, high_water_mark timestamp"


def stored_model(catalog: Catalog, model: str) -> DataFrame:
    """A stored model; a raw table that no ingest has written yet is empty."""
    name = MODELS[model]
    return catalog.read_or_empty(name, RAW_SCHEMA) if name in RAW.values() else catalog.read(name)


def run_ingest(
    catalog: Catalog, feeds: Mapping[str, str], batch_id: str, as_of=None
) -> DataFrame:
    """Appends what is new in each feed (JSON lines by kind) to its raw table, stores what is
    no event under ``<table>_rejects`` and logs the counts; returns the log rows of this batch.

    A batch may be run again: known ids are not appended twice, and its rejects and log rows
    replace those of the first run. The ids of each raw table are indexed beside it; an index that
    is not there, or that a lost run left half written, is built from the table.
    """
    def keep(df: DataFrame, name: str) -> None:
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("batch_id").parquet(catalog.resolve(name))

    counts = None
    for kind, path in feeds.items():
        table = RAW[kind]
        lines = raw.read_jsonl(catalog.spark, path)
        index = IdIndex(catalog.spark, f"{catalog.resolve(table)}_ids")
        if not index.whole():
            index.rebuild(catalog.read_or_empty(table, RAW_SCHEMA))
        result = raw.ingest_incremental(
            lines, index, batch_id, as_of, lambda parsed: catalog.staged(parsed, f"{table}-lines")
        )
        result.new_rows = catalog.staged(result.new_rows, f"{table}-new")
        row = result.metrics.withColumn("feed", F.lit(kind)).first()
        counted = catalog.spark.createDataFrame([row], result.metrics.withColumn("feed", F.lit(kind)).schema)
        counts = counted if counts is None else counts.unionByName(counted)
        keep(result.rejects, f"{table}_rejects")
        with index.adding(result.new_rows):
            raw.write_raw_by_day(result.new_rows, catalog.resolve(table))
    keep(counts, INGEST_LOG)
    return catalog.read(INGEST_LOG).filter(F.col("batch_id") == batch_id)


def run_models(catalog: Catalog, as_of=None) -> dict[str, DataFrame]:
    """Builds and stores every model from the stored raw tables.

    Staging and sessions are stored although they could be views: they feed several
    models each, and parsing and deduplicating the raw JSON again per mart would cost
    far more than writing the columns once.
    """

    def store(df: DataFrame, model: str, *partition_by: str) -> DataFrame:
        return catalog.materialize(df, MODELS[model], partition_by)

    searches, clicks, conversions = (
        store(staging.stage(stored_model(catalog, f"raw_{kind}_events"), kind), f"stg_{kind}_events") for kind in RAW
    )
    sessions = store(search_sessions(searches, clicks, conversions), "int_search_sessions")
    users = store(marts.user_dimension(sessions, as_of), "dim_users")
    return {
        "stg_search_events": searches,
        "stg_click_events": clicks,
        "stg_conversion_events": conversions,
        "int_search_sessions": sessions,
        "int_user_journeys": store(user_journeys(searches, clicks, conversions), "int_user_journeys"),
        "fct_search_funnel": store(marts.search_funnel(sessions), "fct_search_funnel", "funnel_date"),
        "dim_users": users,
        "mart_user_segments": store(
            marts.user_segments(users, searches, conversions, as_of), "mart_user_segments"
        ),
        "mart_recommendations": store(
            recommendations.recommend_user_cf(clicks, conversions, as_of), "mart_recommendations"
        ),
    }


def refresh_funnel(catalog: Catalog) -> DataFrame:
    """Brings the stored daily funnel up to date from the stored staging tables and sessions.

    Only days touched by events ingested since the last refresh are built, however late those are. The
    mark of a refresh is the newest ingest time it has read; it is logged when the days are stored, so a
    lost run is repeated. Rows as old as the mark are taken again, as some may have come after it.
    """
    model, spark = "fct_search_funnel", catalog.spark
    staged = [stored_model(catalog, f"stg_{kind}_events") for kind in RAW]
    sessions = stored_model(catalog, "int_search_sessions")
    marks = catalog.read_or_empty(BUILD_MARKS, MARK_SCHEMA).filter(F.col("model") == model)
    since = marks.agg(F.max("high_water_mark")).first()[0]
    newest = max((t for t in (s.agg(F.max("ingested_at")).first()[0] for s in staged) if t), default=None)
    if since is None:
        stored = catalog.materialize(marts.search_funnel(sessions), MODELS[model], ("funnel_date",))
    else:
        days = catalog.staged(activation.touched_days(staged[0], staged[1:], since), "touched-days")
        stored = activation.materialize_days(
            spark, sessions, days, marts.search_funnel, catalog.resolve(MODELS[model])
        )
    log_run(spark, {"model": model, "high_water_mark": newest}, catalog.resolve(BUILD_MARKS), MARK_SCHEMA)
    return stored


def run_freshness(catalog: Catalog, as_of=None) -> DataFrame:
    """Age of every raw table against its limits."""
    parts = [
        quality.freshness(stored_model(catalog, model), model, "ingested_at", *hours, as_of=as_of)
        for model, hours in FRESHNESS_HOURS.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def store_failures(catalog: Catalog, results: DataFrame) -> list[str]:
    """Stores the rows behind every rule that did not pass; returns the names they have."""
    broken = {(r["model"], r["test_name"]) for r in results.filter("status <> 'pass'").collect()}
    names = []
    for model, rules in RULES.items():
        for i, rule in enumerate(rules):
            if (model, rule.name) in broken:
                names.append(f"ops.failures.{model}.rule_{i}")
                rows = quality.failing_rows(stored_model(catalog, model), rule)
                catalog.materialize(rows.withColumn("test_name", F.lit(rule.name)), names[-1])
    return names


def run_rules(catalog: Catalog) -> DataFrame:
    """All table rules over the stored models."""
    parts = [
        quality.run_quality(stored_model(catalog, model), model, rules)
        for model, rules in RULES.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def verify(catalog: Catalog) -> DataFrame:
    """Row counts of all stored models."""
    return reporting.record_counts({m: stored_model(catalog, m) for m in MODELS})


def high_water_mark(spark: SparkSession, log_path: str, sync_type: str):
    """The newest source row that a sync of this type has read and stored; None before the first.

    It comes from the rows and not from a clock: a table built for an earlier ``as_of``, or stored while
    a sync was running, is newer than what the sync has read, whenever that was.
    """
    try:
        log = spark.read.schema(SYNC_LOG_SCHEMA).parquet(log_path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    good = log.filter((F.col("sync_type") == sync_type) & F.col("error_message").isNull())
    return good.agg(F.max("high_water_mark")).first()[0]


def _counts(source: str, destination: str, extracted: int, upserted: int, unchanged: int = 0) -> dict:
    return {
        "source_table": source, "destination": destination, "rows_extracted": extracted,
        "rows_upserted": upserted, "rows_unchanged": unchanged,
    }


def sync_segments(catalog: Catalog, as_of=None, since=None, dry_run: bool = False) -> dict:
    """Segments changed since the last sync, merged into the CRM snapshot."""
    source, destination = MODELS["mart_user_segments"], "crm.user_segments"
    changed = catalog.staged(activation.changed_since(catalog.read(source), "segmented_at", since), destination)
    current = catalog.read_or_empty(destination, activation.CRM_SCHEMA)
    n = activation.merge_metrics(current, changed).first()
    newest = changed.agg(F.max("segmented_at")).first()[0]
    if not dry_run:
        catalog.replace(activation.merge_segments(current, changed, as_of), destination)
    counts = _counts(source, destination, n["rows_extracted"], n["rows_upserted"], n["rows_unchanged"])
    return {**counts, "high_water_mark": newest or since}


def sync_recommendations(catalog: Catalog, as_of=None, since=None, dry_run: bool = False) -> dict:
    """The whole key-value export: an entry lives for some days, so all are written anew."""
    source, destination = MODELS["mart_recommendations"], "kv.recommendations"
    recommended = catalog.read(source)
    entries = activation.export_reco_kv(recommended, as_of=as_of)
    if not dry_run:
        activation.write_kv(entries, catalog.resolve(destination))
        entries = catalog.read(destination)
    return _counts(source, destination, recommended.count(), entries.count())


def sync_emails(catalog: Catalog, as_of=None, since=None, dry_run: bool = False) -> dict:
    """Mails for abandoned searches, appended to the queue."""
    source, destination = MODELS["stg_search_events"], "crm.email_queue"
    found = catalog.staged(
        activation.abandoned_searches(catalog.read(source), catalog.read(MODELS["stg_conversion_events"]), as_of), destination
    )
    mails = catalog.staged(activation.queue_emails(found, catalog.read_or_empty(destination, QUEUE_SCHEMA), as_of), destination)
    if not dry_run:
        catalog.append(mails, destination)
    return _counts(source, destination, found.count(), mails.count())


SYNCS = {"segments": sync_segments, "recommendations": sync_recommendations, "emails": sync_emails}


def run_named_syncs(
    catalog: Catalog, names: tuple[str, ...] = tuple(SYNCS), as_of=None,
    log_path: str | None = None, dry_run: bool = False,
) -> dict[str, dict | str]:
    """Runs some of ``SYNCS`` from their high-water marks on and logs them; returns their status.

    A dry run writes and logs nothing and returns the counts instead.
    """
    if unknown := set(names) - set(SYNCS):
        raise ValueError(f"no such sync: {', '.join(sorted(unknown))}")
    log_path = log_path or catalog.resolve("ops.sync_log")
    since = {name: high_water_mark(catalog.spark, log_path, name) for name in names}
    if dry_run:
        return {name: SYNCS[name](catalog, as_of, since[name], dry_run=True) for name in names}
    jobs = {name: lambda name=name: SYNCS[name](catalog, as_of, since[name]) for name in names}
    return run_syncs(catalog.spark, jobs, log_path)


def run_syncs(
    spark: SparkSession, syncs: Mapping[str, Callable[[], Mapping]], log_path: str
) -> dict[str, str]:
    """Runs the syncs one by one; a failing one is logged and does not stop the others.

    A sync returns the fields of its log row: ``rows_extracted``, ``rows_upserted``, ``rows_unchanged``,
    ``source_table``, ``destination`` and ``high_water_mark`` as far as it has them.
    """
    status: dict[str, str] = {}
    for name, sync in syncs.items():
        row = {"sync_id": uuid.uuid4().hex, "sync_type": name, "started_at": _now()}
        try:
            row.update(sync())
            status[name] = "success"
        except (PySparkException, ValueError, OSError) as error:
            row["error_message"] = str(error)
            status[name] = "failed"
        row["completed_at"] = _now()
        log_run(spark, row, log_path, SYNC_LOG_SCHEMA)
    return status


def logged(
    spark: SparkSession, dag_id: str, job: Callable[[], int], log_path: str, run_type: str = "manual"
) -> float:
    """Runs one job and appends its run to the log; the error is logged and raised again.
    Returns the seconds it took.
    """
    started = time.monotonic()
    row = {"run_id": uuid.uuid4().hex, "dag_id": dag_id, "run_type": run_type, "started_at": _now()}
    try:
        row["rows_processed"] = job()
        row["status"] = "success"
    except Exception as error:
        row["status"], row["error_message"] = "failed", str(error)
        raise
    finally:
        row["completed_at"] = _now()
        log_run(spark, row, log_path, RUN_LOG_SCHEMA)
    return time.monotonic() - started


def _now() -> datetime:
    return datetime.now(timezone.utc)

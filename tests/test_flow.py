from builders import click, conversion, raw_table, search

from tripfunnel.operators.activation import RUN_LOG_SCHEMA
from tripfunnel.plans import flow
from tripfunnel.sources.catalog import Catalog
from tripfunnel.sources.raw import write_raw_by_day


def test_the_full_run_from_raw_tables_to_rules(spark, tmp_path):
    documents = [search(f"s{i}", f"2024-01-0{1 + i % 3}T10:00:00Z", user=f"u{i}", session=f"x{i}") for i in range(12)]
    documents += [
        click(f"c{i}-{d}", f"2024-01-0{1 + i % 3}T10:05:00Z", f"s{i}", user=f"u{i}", session=f"x{i}", destination=d)
        for i in range(12) for d in (["Miami", "Boston"] if i % 2 else ["Miami", "Boston", "Denver"])
    ]
    documents.append(conversion("v", "2024-01-01T10:09:00Z", "c0-Miami", user="u0", session="x0", value=900.0))
    catalog = Catalog(spark, str(tmp_path))
    for kind, name in flow.RAW.items():
        raw = raw_table(spark, [d for d in documents if d["event_type"] == kind])
        write_raw_by_day(raw, catalog.resolve(name))
    models = flow.run_models(catalog, "2024-01-05 00:00:00")
    assert {r["user_id"]: r["segment"] for r in models["mart_user_segments"].collect()}["u0"] == "high_value"
    recommended = models["mart_recommendations"].collect()
    assert {(r["user_id"], r["recommended_destination"]) for r in recommended} == {
        (u, "Denver") for u in ("u1", "u3", "u5", "u7", "u9", "u11")
    }
    results = {(r["model"], r["test_name"]): r["status"] for r in flow.run_rules(catalog).collect()}
    assert len(results) == 80
    failing = {k for k, v in results.items() if v != "pass"}
    # Two or three clicks per search: the two rate rules report it, as intended.
    assert {m for m, _ in failing} == {"int_search_sessions", "fct_search_funnel", "dim_users"}
    counts = {r["table"]: r["count"] for r in flow.verify(catalog).collect()}
    assert counts["stg_search_events"] == 12 and counts["dim_users"] == 12 and counts["mart_recommendations"] == 6


def test_a_refresh_follows_late_events(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path))
    documents = [search(f"s{i}", f"2024-01-0{1 + i}T10:00:00Z", session=f"x{i}") for i in range(4)]

    def arrive(documents, at):
        for kind, name in flow.RAW.items():
            write_raw_by_day(raw_table(spark, [d for d in documents if d["event_type"] == kind], at), catalog.resolve(name))
        flow.run_models(catalog, "2024-01-30 00:00:00")

    def files():
        folder = tmp_path / "analytics" / "fct_search_funnel"
        return {p.parent.name: p.name for p in folder.glob("*/*.parquet")}

    arrive(documents[:3], "2024-01-05 00:00:00")
    arrive(documents[3:], "2024-01-06 00:00:00")
    flow.refresh_funnel(catalog)
    before = files()
    assert len(before) == 4
    late = [click("c", "2024-01-01T10:05:00Z", "s0", session="x0"), conversion("v", "2024-01-12T00:00:00Z", "c", session="x0")]
    for kind, name in flow.RAW.items():
        write_raw_by_day(raw_table(spark, [d for d in late if d["event_type"] == kind], "2024-01-15 00:00:00"), catalog.resolve(name))
    staged = [catalog.materialize(flow.staging.stage(flow.stored_model(catalog, f"raw_{k}_events"), k), flow.MODELS[f"stg_{k}_events"]) for k in flow.RAW]
    catalog.materialize(flow.search_sessions(*staged), flow.MODELS["int_search_sessions"])
    funnel = {str(r["funnel_date"]): r["total_conversions"] for r in flow.refresh_funnel(catalog).collect()}
    assert funnel == {"2024-01-01": 1, "2024-01-02": 0, "2024-01-03": 0, "2024-01-04": 0}
    after = files()
    # The last day's rows are as old as the mark and are taken again.
    assert {d for d in before if after[d] != before[d]} == {"funnel_date=2024-01-01", "funnel_date=2024-01-04"}


def test_runs_are_logged_with_their_outcome(spark, tmp_path):
    log = str(tmp_path / "runs")
    assert flow.logged(spark, "ingest", lambda: 7, log) >= 0
    try:
        flow.logged(spark, "broken", lambda: 1 // 0, log)
    except ZeroDivisionError:
        pass
    rows = {r["dag_id"]: r for r in spark.read.schema(RUN_LOG_SCHEMA).parquet(log).collect()}
    assert rows["ingest"]["rows_processed"] == 7 and rows["ingest"]["status"] == "success"
    assert rows["broken"]["status"] == "failed" and "division" in rows["broken"]["error_message"]


def test_ingest_models_and_syncs_compose(spark, tmp_path):
    import json

    documents = [search(f"s{i}", "2024-01-04T10:00:00Z", user=f"u{i}", session=f"x{i}") for i in range(5)]
    feed = tmp_path / "feed"
    feed.mkdir()
    (feed / "a.jsonl").write_text("\n".join([*map(json.dumps, documents), json.dumps(documents[0]), "broken", "{}"]))
    catalog = Catalog(spark, str(tmp_path / "warehouse"))
    feeds = {"search": str(feed), "click": str(tmp_path / "none"), "conversion": str(tmp_path / "none")}
    for again in (False, True):
        log = {r["feed"]: r for r in flow.run_ingest(catalog, feeds, f"batch-{again}", "2024-01-05 00:00:00").collect()}
        assert log["search"]["lines_read"] == 8 and log["search"]["malformed"] == 1 and log["search"]["without_id"] == 1
        assert log["search"]["inserted"] == (0 if again else 5)
    assert catalog.read(flow.RAW["search"]).count() == 5
    assert catalog.read(flow.RAW["search"] + "_rejects").filter("batch_id = 'batch-False'").count() == 2
    flow.run_models(catalog, "2024-01-05 00:00:00")
    fresh = {r["model"]: r["status"] for r in flow.run_freshness(catalog, "2024-01-05 02:00:00").collect()}
    assert fresh == {"raw_search_events": "warn", "raw_click_events": "fail", "raw_conversion_events": "fail"}
    assert flow.store_failures(catalog, flow.run_rules(catalog)) == []
    dry = flow.run_named_syncs(catalog, as_of="2024-01-05 00:00:00", dry_run=True)
    assert dry["segments"]["rows_upserted"] == 5 and dry["emails"]["rows_upserted"] == 5
    assert not catalog.exists("crm.user_segments")
    assert set(flow.run_named_syncs(catalog, as_of="2024-01-05 00:00:00").values()) == {"success"}
    assert catalog.read("crm.user_segments").count() == 5 and catalog.read("crm.email_queue").count() == 5
    again = flow.run_named_syncs(catalog, ("segments", "emails"), as_of="2024-01-05 00:00:00", dry_run=True)
    assert again["segments"]["rows_extracted"] == 0 and again["emails"]["rows_upserted"] == 0
    try:
        flow.run_named_syncs(catalog, ("no such",))
        raise AssertionError
    except ValueError:
        pass


def test_a_sync_reads_on_where_the_last_one_stopped(spark, tmp_path):
    """Marks come from the rows: neither a clock in the past nor a slow writer loses an update."""
    catalog = Catalog(spark, str(tmp_path))
    schema = (
        "user_id string, segment string, engagement_score int, lifetime_revenue double, lifetime_conversions int, "
        "primary_platform string, primary_country string, first_seen_at timestamp, last_seen_at timestamp, segmented_at string"
    )

    def build(segment, at):
        rows = [(u, segment, 1, 1.0, 1, "web", "CA", None, None, at) for u in ("a", "b")]
        built = spark.createDataFrame(rows, schema)
        catalog.materialize(built.withColumn("segmented_at", built["segmented_at"].cast("timestamp")), "marketing.mart_user_segments")

    def sync(at):
        assert flow.run_named_syncs(catalog, ("segments",), as_of=at) == {"segments": "success"}
        return {r["segment"] for r in catalog.read("crm.user_segments").collect()}

    def mark():
        return str(flow.high_water_mark(spark, catalog.resolve("ops.sync_log"), "segments"))

    build("regular", "2024-01-30 00:00:00")
    assert sync("2024-01-31 00:00:00") == {"regular"} and mark() == "2024-01-30 00:00:00"
    # Built before that sync, stored after it.
    build("high_value", "2024-01-30 12:00:00")
    assert sync("2024-02-01 00:00:00") == {"high_value"} and mark() == "2024-01-30 12:00:00"
    again = flow.run_named_syncs(catalog, ("segments",), dry_run=True)["segments"]
    assert again["rows_extracted"] == 0 and str(again["high_water_mark"]) == mark()
    assert sync("2024-02-02 00:00:00") == {"high_value"} and mark() == "2024-01-30 12:00:00"
    build("dormant", "2024-01-31 00:00:00")
    assert sync("2024-02-03 00:00:00") == {"dormant"}
    assert {r["previous_segment"] for r in catalog.read("crm.user_segments").collect()} == {"high_value"}


def test_the_mail_queue_only_grows(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path))
    for kind, name in flow.RAW.items():
        docs = [search("s", "2024-01-04T10:00:00Z")] if kind == "search" else [conversion("v", "2023-01-01T00:00:00Z", "c", user="other")]
        write_raw_by_day(raw_table(spark, docs if kind != "click" else [click("c", "2023-01-01T00:00:00Z", "x", user="other")]), catalog.resolve(name))
    flow.run_models(catalog, "2024-01-05 00:00:00")
    files = set()
    for at in ("2024-01-05 00:00:00", "2024-01-05 01:00:00", "2024-01-06 06:00:00"):
        flow.run_named_syncs(catalog, ("emails",), as_of=at)
        now = {f.name for f in (tmp_path / "crm" / "email_queue").glob("*.parquet")}
        assert files <= now
        files = now
    assert catalog.read("crm.email_queue").count() == 1

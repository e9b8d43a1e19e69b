from datetime import datetime

from pyspark.sql import functions as F

from tripfunnel.operators import activation as act
from tripfunnel.plans import flow

SEGMENTS = (
    "user_id string, segment string, engagement_score int, lifetime_revenue double, lifetime_conversions long, "
    "primary_platform string, primary_country string, first_seen_at timestamp, last_seen_at timestamp"
)
T0, T1 = "2024-01-01 00:00:00", "2024-01-02 00:00:00"


def segments(spark, **of):
    rows = [(u, s, n, 10.0, 1, "web", "CA", None, None) for u, (s, n) in of.items()]
    return spark.createDataFrame(rows, SEGMENTS)


def crm(spark, at, **of):
    return act.merge_segments(spark.createDataFrame([], act.CRM_SCHEMA), segments(spark, **of), at)


def rows(df, key="user_id"):
    return {r[key]: r for r in df.collect()}


def test_merge_inserts_updates_and_stamps_changes(spark):
    current = crm(spark, T0, same=("regular", 1), moved=("regular", 1), gone=("regular", 1))
    merged = rows(act.merge_segments(current, segments(spark, same=("regular", 9), moved=("high_value", 1), new=("regular", 1)), T1))
    t1 = datetime(2024, 1, 2)
    assert set(merged) == {"same", "moved", "gone", "new"}
    assert merged["same"]["previous_segment"] == "regular" and merged["same"]["segment_changed_at"] is None
    assert merged["same"]["engagement_score"] == 9
    assert merged["moved"]["previous_segment"] == "regular" and merged["moved"]["segment_changed_at"] == t1
    assert merged["new"]["previous_segment"] is None and merged["new"]["synced_at"] == t1
    assert merged["gone"]["synced_at"] == datetime(2024, 1, 1)


def test_merge_options(spark):
    current = crm(spark, T0, a=("regular", 1))
    incoming = segments(spark, a=("regular", 2), b=("regular", 1), c=("regular", 1))
    quiet = rows(act.merge_segments(current, incoming, T1, only_on_change=True))
    assert quiet["a"]["previous_segment"] is None
    reduced = rows(act.merge_segments(current, incoming.withColumn("primary_platform", F.lit("ios")), T1, track_changes=False))
    assert reduced["a"]["primary_platform"] == "web" and reduced["a"]["engagement_score"] == 2
    assert reduced["a"]["previous_segment"] is None and reduced["b"]["primary_platform"] == "ios"
    assert set(rows(act.merge_segments(current, incoming, T1, limit=2))) == {"a", "b"}


def test_merging_a_table_with_itself_changes_only_bookkeeping(spark):
    incoming = segments(spark, a=("regular", 1), b=("at_risk", 2))
    current = act.merge_segments(spark.createDataFrame([], act.CRM_SCHEMA), incoming, T0)
    again = act.merge_segments(current, incoming, T1)
    kept = ["user_id", *act.CRM_ATTRIBUTES, "segment_changed_at"]
    assert again.select(kept).exceptAll(current.select(kept)).count() == 0
    m = act.merge_metrics(current, incoming).first()
    assert (m["rows_extracted"], m["rows_upserted"], m["rows_unchanged"]) == (2, 0, 2)


def test_merge_metrics_compare_values(spark):
    current = crm(spark, T0, a=("regular", 1), b=("regular", 1))
    m = act.merge_metrics(current, segments(spark, a=("regular", 1), b=("regular", 2), c=("regular", 1))).first()
    assert (m["rows_inserted"], m["rows_updated"], m["rows_unchanged"]) == (1, 1, 1)


def test_cooldown_blocks_only_pending_or_sent_within_a_day(spark):
    names = [f"{s}{h}" for s in ("pending", "sent", "processing", "failed") for h in (23, 25)]
    now = "2024-01-02 00:00:00"
    found = spark.createDataFrame(
        [(n, q, t, 1) for n in names for q, t in (("new", "2024-01-01 20:00:00"), ("old", "2024-01-01 10:00:00"))],
        "user_id string, last_search_query string, t string, search_count long",
    ).withColumn("last_search_time", F.col("t").cast("timestamp"))
    queue = spark.createDataFrame(
        [(n, act.EMAIL_TEMPLATE, n[:-2], int(n[-2:])) for n in names], "user_id string, email_template string, status string, h int"
    ).withColumn("created_at", F.lit(now).cast("timestamp") - F.make_dt_interval(hours=F.col("h")))
    queued = rows(act.queue_emails(found, queue, now))
    assert set(queued) == set(names) - {"pending23", "sent23"}
    assert queued["sent25"]["payload"] == '{"search_query":"new","search_count":1,"personalized_link":"/search?q=new"}'
    assert queued["sent25"]["priority"] == 3


def test_abandoned_searches_respect_both_windows_and_conversions(spark):
    def feed(data):
        df = spark.createDataFrame(data, "user_id string, search_query string, t string")
        return df.withColumn("event_timestamp", F.col("t").cast("timestamp"))

    searches = feed([
        ("a", "q", "2024-01-02 12:00:00"), ("a", "q", "2024-01-01 06:00:00"), ("b", "q", "2024-01-01 12:00:00"),
        ("c", "q", "2024-01-02 12:00:00"), (None, "q", "2024-01-02 12:00:00"), ("d", "q", "2024-01-02 13:00:00"),
    ])
    booked = feed([("c", None, "2024-01-02 10:00:00"), ("d", None, "2023-12-30 00:00:00")])
    found = act.abandoned_searches(searches, booked, "2024-01-03 00:00:00").collect()
    assert sorted((r["user_id"], r["search_count"]) for r in found) == [("a", 2), ("d", 1)]
    assert act.abandoned_searches(searches, booked, "2024-01-03 00:00:00", limit=1).count() == 1


def test_kv_export_bounds_and_lookup(spark):
    recs = spark.createDataFrame(
        [("u", "a", 0.5, 1), ("u", "b", 0.51, 10), ("u", "c", 0.9, 11), ("u", "d", 1.0, 1)],
        "user_id string, recommended_destination string, recommendation_score double, rank int",
    )
    kv = act.export_reco_kv(recs, as_of=T0)
    row = kv.first()
    assert row["key"] == "reco:u" and row["value"] == {"b": 0.51, "d": 1.0}
    assert row["expires_at"] == datetime(2024, 1, 8)
    assert act.lookup_reco(kv, "u", as_of=T1).count() == 2
    assert act.lookup_reco(kv, "u", as_of="2024-01-09 00:00:00").count() == 0
    assert act.lookup_reco(kv, "nobody", as_of=T1).count() == 0


def test_reconcile_names_the_drift(spark):
    mart = spark.createDataFrame([("a", 1, "x"), ("b", 2, None), ("c", 3, "z")], "k string, n int, s string")
    other = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("d", 4, "w")], "k string, n int, s string")
    drift = {r["k"]: (r["drift"], r["columns"]) for r in act.reconcile(mart, other, ["k"], ["n", "s"]).collect()}
    assert drift["b"] == ("different", "s") and drift["c"][0] == "missing_in_destination"
    assert drift["d"][0] == "missing_in_mart" and "a" not in drift


def test_changed_since(spark):
    df = spark.createDataFrame([(T0,), (T1,)], "t string").select(F.col("t").cast("timestamp").alias("t"))
    assert act.changed_since(df, "t", T0).count() == 1 and act.changed_since(df, "t", None).count() == 2


def test_incremental_mart_replaces_only_late_days(spark, tmp_path):
    def load(data):
        return spark.createDataFrame(data, "d string, n int").select(F.col("d").cast("timestamp").alias("session_start"), "n")

    def build(df):
        return df.groupBy(F.to_date("session_start").alias("funnel_date")).agg(F.sum("n").alias("n"))

    path = str(tmp_path / "mart")
    act.materialize_incremental(spark, load([("2024-01-01", 1), ("2024-01-03", 1)]), build, path)
    late = load([("2024-01-01", 50), ("2024-01-02", 7), ("2024-01-03", 5), ("2024-01-04", 2)])
    stored = act.materialize_incremental(spark, late, build, path)
    got = {str(r["funnel_date"]): r["n"] for r in stored.collect()}
    assert got == {"2024-01-01": 1, "2024-01-02": 7, "2024-01-03": 5, "2024-01-04": 2}


def test_reconcile_shuffles_only_buckets_that_differ(spark):
    """Equal to a comparison of all rows; nothing travels where the digests agree."""
    mart = spark.range(20000).select("id", (F.col("id") % 7).alias("n"), F.when(F.col("id") % 5 > 0, "x").alias("s"))
    other = mart.filter("id not in (5, 11)").withColumn("n", F.expr("if(id = 40, -1, n)")).withColumn(
        "s", F.expr("if(id = 55, 'x', s)")
    ).unionByName(spark.createDataFrame([(-3, 1, "y")], "id long, n long, s string"))
    for buckets in (1, 64, 100000):
        found = {r["id"]: (r["drift"], r["columns"]) for r in act.reconcile(mart, other, ["id"], ["n", "s"], buckets).collect()}
        assert {k: v for k, v in found.items() if v[0] == "different"} == {40: ("different", "n"), 55: ("different", "s")}
        assert {k: v[0] for k, v in found.items() if v[0] != "different"} == {
            5: "missing_in_destination", 11: "missing_in_destination", -3: "missing_in_mart"
        }
    assert act.reconcile(mart, mart.withColumn("n", F.col("n").cast("int")), ["id"], ["n", "s"]).count() == 0
    swapped = spark.createDataFrame([(1, None, "a"), (2, "a", None)], "id long, n string, s string")
    back = spark.createDataFrame([(1, "a", None), (2, None, "a")], "id long, n string, s string")
    assert act.reconcile(swapped, back, ["id"], ["n", "s"], 1).count() == 2
    empty = mart.filter("false")
    assert act.reconcile(empty, empty, ["id"], ["n"]).count() == 0 and act.reconcile(mart, empty, ["id"], ["n"]).count() == 20000
    keyless = spark.createDataFrame([(None, 1), (1, 1)], "id long, n int")
    assert sorted(r["drift"] for r in act.reconcile(keyless, keyless, ["id"], ["n"]).collect()) == [
        "missing_in_destination", "missing_in_mart"
    ]


def test_only_touched_days_are_built_again(spark, tmp_path):
    def events(rows):
        return spark.createDataFrame(rows, "session_id string, at string, came string").select(
            "session_id", F.col("at").cast("timestamp").alias("event_timestamp"), F.col("came").cast("timestamp").alias("ingested_at")
        )

    def sessions(df):
        return df.groupBy("session_id").agg(F.min("event_timestamp").alias("session_start"), F.count(F.lit(1)).alias("n"))

    def build(df):
        return df.groupBy(F.to_date("session_start").alias("funnel_date")).agg(F.sum("n").alias("n"))

    def files():
        return {p.parent.name: p.name for p in (tmp_path / "mart").glob("*/*.parquet")}

    old, new = "2024-01-05 00:00:00", "2024-01-20 00:00:00"
    first = [("a", "2024-01-01 10:00:00", old), ("b", "2024-01-03 00:10:00", old), ("c", "2024-01-04 10:00:00", old), (None, None, old)]
    late = [("a", "2024-01-01 09:00:00", new), ("b", "2024-01-02 23:50:00", new)]
    path = str(tmp_path / "mart")
    act.materialize_days(spark, sessions(events(first)), None, build, path)
    before = files()
    everything, clicks = events(first + late), events([("c", "2024-01-04 10:05:00", old), (None, "2024-01-04 10:05:00", old)])
    days = act.touched_days(everything, [clicks], new)
    # Session b opens a day earlier now, so the day it leaves is touched too, and has no session any more.
    assert sorted(str(r["day"]) for r in days.collect()) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    stored = act.materialize_days(spark, sessions(everything), days, build, path)
    got = {str(r["funnel_date"]): r["n"] for r in stored.collect()}
    assert got == {"2024-01-01": 2, "2024-01-02": 2, "2024-01-04": 1, "None": 1}
    after = files()
    same = {d for d in before if after.get(d) == before[d]}
    assert same == {"funnel_date=2024-01-04", "funnel_date=__HIVE_DEFAULT_PARTITION__"}
    touched = act.touched_days(everything, [events([("c", "2024-01-04 11:00:00", new), (None, "2024-01-04 11:00:00", new)])], new)
    assert {str(r["day"]) for r in touched.collect()} == {"2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04", "None"}
    assert act.touched_days(everything, [clicks], "2024-02-01 00:00:00").count() == 0


def test_fan_out_and_partitioned_events(spark, tmp_path):
    df = spark.createDataFrame([("search", "a"), ("click", "b")], "event_type string, event_id string")
    paths = [str(tmp_path / n) for n in "xy"]
    act.fan_out(df, [lambda d: d.write.parquet(paths[0]), lambda d: act.write_events(d, paths[1])])
    assert spark.read.parquet(paths[0]).count() == 2
    assert sorted(p.name for p in (tmp_path / "y").iterdir() if p.is_dir()) == ["event_type=click", "event_type=search"]


def test_a_failing_sync_is_logged_and_the_rest_runs(spark, tmp_path):
    def broken():
        raise ValueError("no destination")

    status = flow.run_syncs(spark, {"bad": broken, "good": lambda: {"rows_extracted": 3}}, str(tmp_path / "log"))
    log = rows(spark.read.schema(act.SYNC_LOG_SCHEMA).parquet(str(tmp_path / "log")), "sync_type")
    assert status == {"bad": "failed", "good": "success"}
    assert log["bad"]["error_message"] == "no destination" and log["good"]["rows_extracted"] == 3

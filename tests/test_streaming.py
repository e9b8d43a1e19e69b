import json
import time

from builders import click, conversion, search, stage_all
from pyspark.sql import functions as F

from tripfunnel.operators import activation
from tripfunnel.operators.journeys import user_journeys
from tripfunnel.sources.streams import stream_events
from tripfunnel.streaming import events as streaming
from tripfunnel.streaming import late
from tripfunnel.streaming.snapshots import Snapshot


def feed(spark, folder, *batches):
    """One file per batch, oldest first."""
    folder.mkdir(parents=True, exist_ok=True)
    for i, docs in enumerate(batches):
        (folder / f"{i}.jsonl").write_text("\n".join(json.dumps(d) for d in docs) + "\n")
        time.sleep(0.05)
    return stream_events(spark, str(folder), max_files_per_trigger=1)


def drain(spark, df, tmp_path, name):
    query = streaming.write_stream(df, str(tmp_path / f"{name}-out"), str(tmp_path / f"{name}-state"))
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(str(tmp_path / f"{name}-out")), query


def test_repeats_are_dropped_across_batches_and_rejects_are_split(spark, tmp_path):
    docs = [search(str(i), f"2024-01-01T0{i}:00:00Z") for i in range(5)]
    raw = feed(spark, tmp_path / "in", docs, docs[2:] + [search("bad", "2024-01-01T00:00:00Z", page="one")])
    staged = streaming.stream_dedupe(streaming.stream_staging(raw, "search"))
    out, _ = drain(spark, staged, tmp_path, "dedupe")
    assert sorted(r["event_id"] for r in out.collect()) == ["0", "1", "2", "3", "4"]
    rejects, _ = drain(spark, streaming.stream_rejects(raw, "search").select("event_id", "bad_fields"), tmp_path, "rej")
    assert [(r["event_id"], r["bad_fields"]) for r in rejects.collect()] == [("bad", "page_number")]


def test_an_event_beyond_the_watermark_is_dropped_and_counted(spark, tmp_path):
    raw = feed(
        spark, tmp_path / "in",
        [search("a", "2024-01-03T12:00:00Z")],
        [search("b", "2024-01-03T13:00:00Z")],
        [search("late", "2024-01-02T11:00:00Z"), search("end", "2024-01-10T00:00:00Z")],
    )
    windows = streaming.stream_funnel(streaming.stream_staging(raw, "search"), size="1 hour")
    out, query = drain(spark, windows, tmp_path, "late")
    starts = sorted(str(r["window_start"]) for r in out.collect())
    assert starts == ["2024-01-03 12:00:00", "2024-01-03 13:00:00"]
    assert streaming.dropped_by_watermark(query) == 1


def test_sessions_close_after_the_gap(spark, tmp_path):
    times = ["00:00", "00:20", "01:30"]
    raw = feed(
        spark, tmp_path / "in", [search(t, f"2024-01-01T{t}:00Z") for t in times],
        [search("end", "2024-01-05T00:00:00Z", user="other")],
    )
    out, _ = drain(spark, streaming.stream_sessions(streaming.stream_staging(raw, "search")), tmp_path, "sess")
    assert sorted((str(r["session_start"])[11:16], r["events"]) for r in out.collect()) == [("00:00", 2), ("01:30", 1)]


def test_stream_journeys_equal_batch_journeys(spark, tmp_path):
    docs = [
        search("s1", "2024-01-01T10:00:00Z"), search("s2", "2024-01-01T11:00:00Z"), search("s3", "2024-01-01T12:00:00Z"),
        click("c1", "2024-01-01T10:05:00Z", "s1"), click("c2", "2024-01-01T10:06:00Z", "s1"), click("c3", "2024-01-01T12:30:00Z", "s3"),
        conversion("v1", "2024-01-01T10:30:00Z", "c1"),
    ]
    ends = {"search": search("s-end", "2024-01-20T00:00:00Z"), "click": click("c-end", "2024-01-20T00:00:00Z", "x"),
            "conversion": conversion("v-end", "2024-01-20T00:00:00Z", "x")}
    feeds = {
        kind: streaming.stream_staging(
            feed(spark, tmp_path / kind, [d for d in docs if d["event_type"] == kind], [end], [end]), kind
        )
        for kind, end in ends.items()
    }
    out, _ = drain(spark, streaming.stream_journeys(feeds["search"], feeds["click"], feeds["conversion"]), tmp_path, "j")
    columns = ["search_event_id", "click_event_id", "conversion_event_id", "journey_stage"]
    batch = user_journeys(*stage_all(spark, docs)).select(columns)
    streamed = out.select(columns).filter(F.col("search_event_id") != "s-end")
    assert sorted(map(str, streamed.collect())) == sorted(map(str, batch.collect()))


def segments(spark, *rows):
    return spark.createDataFrame(list(rows), "user_id string, segment string").select(
        "user_id", "segment", F.lit(1).alias("engagement_score"), F.lit(1.0).alias("lifetime_revenue"),
        F.lit(1).alias("lifetime_conversions"), F.lit("web").alias("primary_platform"),
        F.lit("CA").alias("primary_country"), F.lit(None).cast("timestamp").alias("first_seen_at"),
        F.lit(None).cast("timestamp").alias("last_seen_at"),
    )


def merge(current, batch):
    return activation.merge_segments(current, batch, "2024-01-01 00:00:00")


def test_snapshot_merge_survives_a_repeated_batch(spark, tmp_path):
    crm = Snapshot(spark, str(tmp_path / "crm"), activation.CRM_SCHEMA, buckets=4)
    apply = crm.merging(merge)
    apply(segments(spark, ("u", "regular")), 0)
    apply(segments(spark, ("u", "high_value")), 1)
    apply(segments(spark, ("u", "high_value")), 1)
    row = crm.latest().first()
    assert (row["segment"], row["previous_segment"]) == ("high_value", "regular")


def test_a_batch_rewrites_only_its_buckets_and_old_versions_go(spark, tmp_path):
    crm = Snapshot(spark, str(tmp_path / "crm"), activation.CRM_SCHEMA, buckets=8)
    assert crm.latest().count() == 0
    users = [(f"u{i}", "regular") for i in range(100)]
    assert crm.upsert(merge, segments(spark, *users), 0) == list(range(8))
    files = lambda: {str(f.relative_to(tmp_path)) for f in tmp_path.rglob("*.parquet")}
    data = lambda: {f for f in files() if "/data/" in f}
    first = data()
    for version in range(1, 6):
        (bucket,) = crm.upsert(merge, segments(spark, ("u7", f"s{version}")), version)
        assert len({f.split("/")[2:4][0] + f.split("/")[3] for f in data() - first if f"version={version}/" in f}) == 1
    kept = {f for f in data() if "version=0/" in f}
    assert kept == {f for f in first if f"bucket={bucket}/" not in f}
    assert {f.split("/")[2] for f in data()} == {"version=0", "version=4", "version=5"}
    assert {f.split("/")[2] for f in files() if "/pointers/" in f} == {"version=4", "version=5"}
    found = {r["user_id"]: r["segment"] for r in crm.latest().collect()}
    assert found == {**dict(users), "u7": "s5"}
    assert crm.upsert(merge, segments(spark), 6) == []
    assert crm.latest().count() == 100


def test_late_rows_are_those_the_watermark_drops(spark, tmp_path):
    batches = [
        [search("a", "2024-01-03T12:00:00Z"), search("first", "2023-12-01T00:00:00Z")],
        [search("b", "2024-01-03T13:00:00Z"), search("edge", "2024-01-02T12:00:00Z"), search("in", "2024-01-02T12:00:00.001Z")],
        [search("late", "2024-01-02T11:00:00Z"), search("end", "2024-01-10T00:00:00Z"), search("at the mark", "2024-01-02T12:00:00Z")],
        [search("in time", "2024-01-09T00:00:01Z")],
    ]
    staged = streaming.stream_staging(feed(spark, tmp_path / "in", *batches), "search")
    root = str(tmp_path / "split")
    query = late.split_stream(staged, root, str(tmp_path / "split-state"))
    query.awaitTermination()
    kept = late.late_rows(spark, root, staged.schema)
    found = {r["event_id"]: (r["batch"], round(r["late_by_seconds"])) for r in kept.collect()}
    assert found == {"late": (2, 3600), "at the mark": (2, 0)}
    _, dedupe = drain(spark, streaming.stream_dedupe(staged), tmp_path, "dedupe")
    assert streaming.dropped_by_watermark(dedupe) == len(found)
    on_time, after = drain(spark, streaming.stream_dedupe(late.on_time_rows(spark, root, staged.schema)), tmp_path, "in-time")
    assert {r["event_id"] for r in on_time.collect()} == {"a", "first", "b", "edge", "in", "end", "in time"}
    # The same batch once more replaces its rows and changes no mark.
    rows = spark.read.schema(staged.schema).parquet(f"{root}/late/batch=2").unionByName(spark.read.schema(staged.schema).parquet(f"{root}/on_time/batch=2"))
    late.split_late(spark, spark.createDataFrame(rows.collect(), staged.schema), 2, root, "event_timestamp", "24 hours")
    assert late.late_rows(spark, root, staged.schema).count() == 2

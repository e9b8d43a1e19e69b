import random

import pytest
from builders import click, conversion, search, stage_all
from pyspark.sql import functions as F

from tripfunnel.operators.journeys import attribute, user_journeys
from tripfunnel.operators.rows import left_join_many, search_text
from tripfunnel.operators import sessions
from tripfunnel.operators.sessions import search_sessions
from tripfunnel.operators import timeline
from tripfunnel.operators.timeline import carry_forward, sessionize


def by(df, key):
    return {r[key]: r for r in df.collect()}


def at(minute):
    return f"2024-01-01T{minute // 60:02d}:{minute % 60:02d}:00Z"


def test_session_outcomes_context_and_ratios(spark):
    staged = stage_all(
        spark,
        [
            search("s1", at(0), session="A", platform="ios"),
            search("s2", at(6), session="A", user=None, platform="web", query="other"),
            search("s3", at(0), session="B"),
            search("s4", at(0), session="C"),
            *[click(f"c{i}", at(1), "s3", session="B") for i in range(3)],
            click("c9", at(1), "s4", session="C"),
            conversion("v1", at(2), "c9", session="C", value=250.0),
            click("orphan", at(1), "s9", session="no search"),
        ],
    )
    rows = by(search_sessions(*staged), "session_id")
    assert set(rows) == {"A", "B", "C"}
    assert [rows[k]["session_outcome"] for k in "ABC"] == ["bounced", "engaged", "converted"]
    assert rows["A"]["platform"] == "ios" and rows["A"]["user_id"] == "u1"
    assert rows["A"]["session_duration_minutes"] == 6.0 and rows["A"]["unique_queries"] == 2
    assert rows["B"]["session_ctr"] == 3.0 and rows["B"]["avg_click_position"] == 2.0
    assert float(rows["C"]["total_booking_value"]) == 250.0 and rows["A"]["avg_click_position"] == 0.0


def test_searches_without_session_form_one_row_without_context_or_clicks(spark):
    staged = stage_all(
        spark,
        [
            search("s1", at(0), session=None), search("s2", at(3), session=None),
            click("c1", at(1), "s1", session=None),
            conversion("v1", at(2), "c1", session=None),
        ],
    )
    (row,) = search_sessions(*staged).collect()
    assert row["search_count"] == 2 and row["click_count"] == 0 and row["platform"] is None


def test_journeys_fan_out_and_drop_orphans(spark):
    staged = stage_all(
        spark,
        [
            search("s1", at(0)), search("s2", at(1)),
            click("c1", at(2), "s1"), click("c2", at(3), "s1"), click("c3", at(3), "missing"),
            click("c4", at(3), None),
            conversion("v1", at(5), "c1", value=80.0), conversion("v2", at(5), None),
        ],
    )
    rows = by(user_journeys(*staged), "click_event_id")
    assert len(rows) == 3 and user_journeys(*staged).count() == 3
    assert rows["c1"]["journey_stage"] == "converted" and rows["c2"]["journey_stage"] == "clicked"
    assert rows[None]["journey_stage"] == "searched_only" and rows[None]["search_event_id"] == "s2"
    assert rows["c1"]["search_to_click_minutes"] == 2.0
    assert rows["c1"]["click_to_conversion_minutes"] == 3.0
    assert float(rows["c1"]["attributed_revenue"]) == 80.0


def test_left_join_many_equals_a_plain_left_join_under_a_hot_key(spark):
    left = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("a"))
    right = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 90).alias("r"),
        F.col("id").alias("b"),
    )
    ours = left_join_many(left, right, "k", "r").select("k", "a", "b")
    plain = left.join(right, left["k"] == right["r"], "left").select("k", "a", "b")
    assert ours.exceptAll(plain).count() == 0 and plain.exceptAll(ours).count() == 0


def events_df(spark, rows):
    df = spark.createDataFrame(rows, "user_id string, secs double, event_id string")
    return df.withColumn("event_timestamp", F.timestamp_micros((F.col("secs") * 1_000_000).cast("long")))


def test_session_gap_opens_only_beyond_the_timeout(spark):
    rows = [("u", 0.0, "a"), ("u", 1800.0, "b"), ("u", 3600.000001, "c"), (None, 0.0, "d")]
    numbers = by(sessionize(events_df(spark, rows)), "event_id")
    assert [numbers[k]["session_number"] for k in "abcd"] == [1, 1, 2, None]


def test_sessionize_matches_a_scan_with_one_hot_user(spark):
    rng = random.Random(1)
    rows = [("hot" if i % 3 == 0 else f"u{i % 40}", round(rng.uniform(0, 400_000), 3), f"e{i}") for i in range(3000)]
    got = {r["event_id"]: r["session_number"] for r in sessionize(events_df(spark, rows), timeout_minutes=20).collect()}
    last, number, want = {}, {}, {}
    for user, secs, event in sorted(rows, key=lambda r: (r[0], r[1])):
        if user not in last or round((secs - last[user]) * 1e6) > 1200 * 1e6:
            number[user] = number.get(user, 0) + 1
        last[user] = secs
        want[event] = number[user]
    assert got == want


@pytest.mark.parametrize("bucket", [1, 60, 10_000_000])
def test_carry_forward_does_not_depend_on_the_bucket(spark, bucket):
    rng = random.Random(2)
    rows = [(f"u{i % 4}", float(rng.randint(0, 3000)), f"e{i:04d}") for i in range(600)]
    df = events_df(spark, rows).withColumn("mark", F.when(F.rand(3) < 0.2, F.col("event_id")))
    df = spark.createDataFrame(df.collect(), df.schema)
    got = {
        r["event_id"]: r["seen"]
        for r in carry_forward(df, "user_id", "event_timestamp", ["event_id"], {"seen": F.col("mark")}, bucket).collect()
    }
    seen, want = {}, {}
    for r in sorted(df.collect(), key=lambda r: (r["secs"], r["event_id"])):
        if r["mark"]:
            seen[r["user_id"]] = r["mark"]
        want[r["event_id"]] = seen.get(r["user_id"])
    assert got == want


def test_attribution_matches_all_pairs(spark):
    rng = random.Random(5)
    touches = [(f"u{rng.randint(0, 3)}", float(rng.randint(0, 300) * 3600), f"t{i:03d}") for i in range(150)]
    bookings = [(f"u{rng.randint(0, 3)}", float(rng.randint(0, 300) * 3600), f"v{i:03d}") for i in range(80)]
    bookings.append((None, 0.0, "v-null"))
    t, v = events_df(spark, touches + [(None, 0.0, "t-null")]), events_df(spark, bookings)
    last = by(attribute(v, t, 24, "last"), "event_id")
    first = by(attribute(v, t, 24, "first"), "event_id")
    every = by(attribute(v, t, 24, "any"), "event_id")
    assert len(last) == len(first) == len(every) == 81
    for user, secs, event in bookings:
        hits = sorted((s, e) for u, s, e in touches if u == user and secs - 86400 <= s <= secs)
        assert last[event]["touch_event_id"] == (hits[-1][1] if hits else None)
        earliest = [e for s, e in hits if s == hits[0][0]]
        assert first[event]["touch_event_id"] == (max(earliest) if hits else None)
        assert every[event]["touch_count"] == len(hits)


def test_search_text_ignores_case_and_blank_terms(spark):
    df = spark.createDataFrame([("hotels in miami",), ("flights",)], "q string")
    assert search_text(df, "q", "MIAMI").count() == 1 and search_text(df, "q", "  ").count() == 2


def test_search_without_a_time_does_not_open_the_session(spark):
    documents = [
        search("a", None, platform="none"), search("b", "2024-01-01T10:05:00Z", platform="second"),
        search("c", "2024-01-01T10:00:00Z", platform="first"), search("d", None, session="s2", platform="only"),
    ]
    rows = sessions.session_searches(stage_all(spark, documents)[0]).select("session_id", "_context.platform").collect()
    assert {r["session_id"]: r["platform"] for r in rows} == {"s1": "first", "s2": "only"}


def test_equal_conversions_keep_their_rows(spark):
    at = "2024-01-01 10:00:00"
    moment = lambda df: df.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
    touches = moment(spark.createDataFrame([("t1", "u", at), ("t2", "u", at)], "event_id string, user_id string, event_timestamp string"))
    rows = [("v", "u", at, 5), ("v", "u", at, 5), ("w", "other", at, 1), ("x", None, at, 1), ("x", None, at, 1)]
    bookings = moment(spark.createDataFrame(rows, "event_id string, user_id string, event_timestamp string, value int"))
    found = attribute(bookings, touches, model="any")
    assert sorted((r["event_id"], r["touch_count"]) for r in found.collect()) == [("v", 2), ("v", 2), ("w", 0), ("x", 0), ("x", 0)]
    assert attribute(bookings, touches, model="last").count() == 5


def test_a_burst_is_cut_and_attributed_exactly(spark):
    """A third of all rows are one user's, in one minute; many at the same instant."""
    rng = random.Random(8)
    spread = lambda: (f"u{rng.randint(0, 9)}", float(rng.randint(0, 86400)))
    burst = lambda: ("hot", float(rng.randint(43200, 43259)))
    touches = [(*(burst() if i % 3 == 0 else spread()), f"t{i:04d}") for i in range(900)]
    bookings = [(*(burst() if i % 3 == 0 else spread()), f"v{i:04d}") for i in range(300)]
    t, v = events_df(spark, touches), events_df(spark, bookings)
    hours = 20 / 3600
    options = {"window_hours": hours, "burst_rows": 40}
    last, first, every = (by(attribute(v, t, model=m, **options), "event_id") for m in ("last", "first", "any"))
    for user, secs, event in bookings:
        hits = sorted((s, e) for u, s, e in touches if u == user and secs - 20 <= s <= secs)
        assert last[event]["touch_event_id"] == (hits[-1][1] if hits else None)
        assert first[event]["touch_event_id"] == (max(e for s, e in hits if s == hits[0][0]) if hits else None)
        assert every[event]["touch_count"] == len(hits)
    bucketed = t.withColumn(timeline.BUCKET, timeline._bucket("event_timestamp", 300))
    cut = timeline.spread_bursts(bucketed, "user_id", "event_timestamp", ["event_id"], 40)
    sizes = [r["count"] for r in cut.groupBy("user_id", timeline.BUCKET, timeline.PART).count().collect()]
    assert sum(sizes) == 900 and max(sizes) < 160

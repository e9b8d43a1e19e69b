import pytest
from pyspark.sql import functions as F

from tripfunnel.functions import scalar
from tripfunnel.plans import marts

USER = (
    "user_id string, lifetime_revenue decimal(20,2), lifetime_conversions long, account_age_days double, "
    "days_since_last_seen double, total_sessions long, avg_ctr double, lifetime_searches long, "
    "first_seen_at timestamp, last_seen_at timestamp, primary_platform string, primary_country string"
)
NOW = "2024-02-01 00:00:00"


def users(spark, **cases):
    from decimal import Decimal

    rows = []
    for name, case in cases.items():
        c = {"revenue": "0", "conversions": 0, "age": 90.0, "idle": 1.0, "sessions": 1, "ctr": 0.0, **case}
        rows.append(
            (name, Decimal(c["revenue"]), c["conversions"], c["age"], c["idle"], c["sessions"], c["ctr"], 1,
             None, None, "web", "CA")
        )
    return spark.createDataFrame(rows, USER)


def events(spark, rows):
    df = spark.createDataFrame(rows, "user_id string, t string")
    return df.select("user_id", F.col("t").cast("timestamp").alias("event_timestamp"))


def test_segment_boundaries_and_order(spark):
    table = users(
        spark,
        rich={"revenue": "500.01"}, edge={"revenue": "500.00"},
        loyal={"conversions": 5}, four={"conversions": 4},
        fresh={"age": 7.0}, older={"age": 7.01},
        gone={"idle": 30.01, "conversions": 1}, nearly={"idle": 30.0, "conversions": 1},
        gone_without={"idle": 30.01}, looking={}, bought={},
    )
    searched = events(spark, [("looking", "2024-01-30 00:00:00"), ("bought", "2024-01-31 00:00:00"),
                              ("rich", "2024-01-31 00:00:00"), ("older", "2024-01-29 23:59:59")])
    booked = events(spark, [("bought", "2024-01-31 10:00:00")])
    got = {r["user_id"]: r["segment"] for r in marts.user_segments(table, searched, booked, NOW).collect()}
    assert got == {
        "rich": "high_value", "edge": "regular", "loyal": "high_value", "four": "regular",
        "fresh": "new_user", "older": "regular", "gone": "at_risk", "nearly": "regular",
        "gone_without": "regular", "looking": "abandoned_search", "bought": "regular",
    }


@pytest.mark.parametrize(
    "ctr, points", [(2.5 / 60, 2), (3.5 / 60, 4), (0.3, 18), (0.31, 20), (0.0, 0)]
)
def test_click_points_round_half_to_even(spark, ctr, points):
    row = spark.range(1).select(
        scalar.engagement_score(F.lit(0), F.lit(0), F.lit(ctr), F.lit(99.0)).alias("s")
    ).first()
    assert row["s"] == points


@pytest.mark.parametrize(
    "idle, points", [(6.99, 20), (7.0, 15), (13.99, 15), (14.0, 10), (29.99, 10), (30.0, 0)]
)
def test_recency_tiers(spark, idle, points):
    row = spark.range(1).select(
        scalar.engagement_score(F.lit(0), F.lit(0), F.lit(0.0), F.lit(idle)).alias("s")
    ).first()
    assert row["s"] == points


def test_score_is_capped_at_100(spark):
    row = spark.range(1).select(
        scalar.engagement_score(F.lit(9), F.lit(50), F.lit(0.9), F.lit(0.0)).alias("s")
    ).first()
    assert row["s"] == 100


def test_segments_partition_the_users(spark):
    table = users(spark, **{f"u{i}": {"idle": float(i), "conversions": i % 7} for i in range(40)})
    nobody = events(spark, [("x", NOW)])
    assert marts.user_segments(table, nobody, nobody, NOW).select("user_id").distinct().count() == 40


def test_text_rules(spark):
    df = spark.createDataFrame(
        [("Cheap flight to las vegas",), ("airbnb in Paris",), ("rent a CAR",), ("nothing",), (None,)], "q string"
    )
    rows = df.select(
        scalar.destination_of(F.col("q")).alias("d"), scalar.product_type_of(F.col("q")).alias("p")
    ).collect()
    assert [r["d"] for r in rows] == ["Las Vegas", None, None, None, None]
    assert [r["p"] for r in rows] == ["flight", "hotel", "car", None, None]


def test_device_and_risk(spark):
    row = spark.range(1).select(
        scalar.device_of(F.lit("ios")).alias("a"), scalar.device_of(F.lit("web"), F.lit("tablet")).alias("b"),
        scalar.device_of(F.lit("tv")).alias("c"), scalar.risk_level(F.lit(0.3)).alias("m"),
        scalar.risk_level(F.lit(0.29)).alias("l"), scalar.risk_level(F.lit(0.7)).alias("h"),
    ).first()
    assert tuple(row) == ("mobile", "tablet", "desktop", "medium", "low", "high")


def test_primary_value_as_maximum_or_mode(spark):
    from datetime import datetime

    t = datetime(2024, 1, 1)
    rows = [(f"s{i}", "u", t, t, p) for i, p in enumerate(["android", "android", "web"])]
    sessions = spark.createDataFrame(rows, "session_id string, user_id string, session_start timestamp, session_end timestamp, platform string")
    for c in ("search_count", "click_count", "conversion_count"):
        sessions = sessions.withColumn(c, F.lit(1).cast("long"))
    for c in ("session_duration_minutes", "session_ctr", "session_conversion_rate"):
        sessions = sessions.withColumn(c, F.lit(0.5))
    for c in ("total_booking_value", "total_commission"):
        sessions = sessions.withColumn(c, F.lit(10).cast("decimal(20,2)"))
    sessions = sessions.withColumns({"device_type": F.lit("mobile"), "geo_country": F.lit("CA")})
    top = marts.user_dimension(sessions, NOW).first()
    usual = marts.user_dimension(sessions, NOW, primary="mode").first()
    assert (top["primary_platform"], usual["primary_platform"]) == ("web", "android")
    assert top["days_since_last_seen"] == 31.0 and top["revenue_per_session"] == 10.0

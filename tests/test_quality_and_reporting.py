from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tripfunnel.functions import ranking
from tripfunnel.operators import quality, reporting
from tripfunnel.plans.rules import RULES


def test_rule_set_has_the_published_size():
    kinds = [r.kind for rules in RULES.values() for r in rules]
    assert len(kinds) == 80
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "unique": 9, "not_null": 33, "accepted_values": 7, "accepted_range": 22,
        "expression_is_true": 8, "unique_combination": 1,
    }


def test_every_rule_kind_counts_its_failures(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 5, None), (None, None, "y"), (None, 11, "x")], "id string, n int, s string"
    )
    rules = [
        quality.unique("id"), *quality.not_null("id"), quality.accepted_values("s", "x"),
        quality.accepted_range("n", 1, 10), quality.expression_is_true("n < 5", where="s IS NULL"),
        quality.unique("s", "n"),
        quality.Rule("not_null", ("s",), severity="error"),
    ]
    rows = quality.run_quality(df, "m", rules).collect()
    got = {r["test_name"]: (r["failures"], r["status"]) for r in rows}
    assert got == {
        "unique: id": (1, "warn"), "not_null: id": (2, "warn"), "accepted_values: s": (1, "warn"),
        "accepted_range: n": (1, "warn"), "expression_is_true: n < 5": (1, "warn"),
        "unique_combination: s_n": (0, "pass"), "not_null: s": (1, "fail"),
    }
    assert quality.failing_rows(df, quality.accepted_range("n", 1, 10)).first()["n"] == 11
    summary = quality.quality_summary(quality.run_quality(df, "m", rules)).first()
    assert (summary["tests"], summary["passed"], summary["failed"]) == (7, 1, 1)


def test_summary_of_no_tests_is_zero(spark):
    empty = spark.createDataFrame([], "status string")
    assert quality.quality_summary(empty).first()["pass_rate"] == 0.0


@pytest.mark.parametrize("hour, status", [(1, "pass"), (2, "warn"), (7, "fail")])
def test_freshness(spark, hour, status):
    df = spark.createDataFrame([(datetime(2024, 1, 1),)], "t timestamp")
    as_of = f"2024-01-01 {hour:02d}:00:00"
    assert quality.freshness(df, "m", "t", 1, 6, as_of).first()["status"] == status
    assert quality.freshness(df.filter(F.lit(False)), "m", "t", 1, 6, as_of).first()["status"] == "fail"


def test_relationships_count_orphan_rows(spark):
    child = spark.createDataFrame([("a",), ("x",), ("x",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("a",)], "k string")
    assert quality.relationships(child, "k", parent, "k", "m").first()["failures"] == 2


def series(spark, n):
    return spark.range(n).select(
        F.timestamp_millis(F.col("id") * 1000).alias("ts"), F.col("id").cast("double").alias("v")
    )


def test_downsample_edges(spark):
    kept = reporting.downsample(series(spark, 20), "ts", "v", 10, average=False).collect()
    assert len(kept) == 20 and all(r["count"] == 1 for r in kept)
    thin = reporting.downsample(series(spark, 21), "ts", "v", 10).orderBy("timestamp_ms").collect()
    assert len(thin) == 11 and thin[-1]["count"] == 1 and sum(r["count"] for r in thin) == 21
    assert thin[0]["value"] == 0.5 and thin[0]["max_value"] == 1.0
    same = series(spark, 30).withColumn("ts", F.lit(datetime(2024, 1, 1)))
    assert reporting.downsample(same, "ts", "v", 10).count() == 1


def funnel(spark, *rows):
    return spark.createDataFrame(
        rows, "funnel_date date, platform string, total_searches long, total_clicks long, total_conversions long"
    )


def test_funnel_steps_rates_and_empty_funnel(spark):
    day = datetime(2024, 1, 1).date()
    steps = reporting.funnel_steps(funnel(spark, (day, "web", 200, 50, 5))).orderBy("step").collect()
    assert [r["conversion_rate"] for r in steps] == [100.0, 25.0, 10.0]
    assert [r["width_percent"] for r in steps] == [100.0, 25.0, 2.5] and steps[2]["lost"] == 45
    none = reporting.funnel_steps(funnel(spark).limit(0)).orderBy("step").collect()
    assert [r["conversion_rate"] for r in none] == [100.0, None, None]


def test_revenue_at_risk(spark):
    day = datetime(2024, 1, 1).date()
    row = reporting.revenue_at_risk(funnel(spark, (day, "web", 106, 9, 3))).first()
    assert (row["lost_bookings"], row["revenue_at_risk"]) == (5, 2250.0)
    enough = reporting.revenue_at_risk(funnel(spark, (day, "web", 100, 9, 30))).first()
    assert enough["revenue_at_risk"] == 0.0


def test_year_over_year_with_leap_days(spark):
    days = ["2023-02-28", "2024-02-28", "2024-02-29", "2025-02-28"]
    df = spark.createDataFrame([(d, 10.0 * (i + 1)) for i, d in enumerate(days)], "d string, m double")
    kpi = reporting.kpi_by_period(df.withColumn("d", F.col("d").cast("date")), "day", "d", ["m"])
    got = {str(r["period"]): r["m_last_year"] for r in kpi.collect()}
    assert got == {"2023-02-28": None, "2024-02-28": 10.0, "2024-02-29": None, "2025-02-28": 20.0}


def test_transitions_and_record_trend(spark):
    snaps = spark.createDataFrame(
        [("u", "regular", 1), ("u", "high_value", 2), ("u", "high_value", 3), ("v", "regular", 1)],
        "user_id string, segment string, segmented_at int",
    )
    (move,) = reporting.segment_transitions(snaps).collect()
    assert (move["from_segment"], move["to_segment"], move["changed_at"], move["users"]) == ("regular", "high_value", 2, 1)
    history = spark.createDataFrame([("t", 1, 0), ("t", 2, 8), ("t", 3, 10)], "`table` string, updated_at int, count long")
    trend = reporting.record_count_trend(history).orderBy("updated_at").collect()
    assert [r["delta_percent"] for r in trend] == [0.0, 0.0, 25.0]


def lists(spark, *rows):
    return spark.createDataFrame(rows, "p array<string>, a array<string>")


def test_ranking_metric_edges(spark):
    df = lists(
        spark,
        (["a", "b", "c"], ["a", "c", "x"]), ([], ["a"]), (["a"], []), (["a"], ["a", "a"]), (None, ["a"]),
    )
    p, a = F.col("p"), F.col("a")
    rows = df.select(
        ranking.precision_at_k(p, a, 2).alias("p2"), ranking.precision_at_k(p, a, 10).alias("p10"),
        ranking.recall_at_k(p, a, 10).alias("r"), ranking.ndcg_at_k(p, a, 10).alias("n"),
        ranking.average_precision_at_k(p, a, 10).alias("ap"),
    ).collect()
    assert [r["p2"] for r in rows] == [0.5, 0.0, 0.0, 0.5, 0.0] and rows[0]["p10"] == 0.2
    assert rows[0]["r"] == pytest.approx(2 / 3) and rows[3]["r"] == 1.0
    # Repeated relevant items lengthen the ideal ranking.
    assert rows[3]["n"] == pytest.approx(1 / (1 + 1 / 1.5849625007211562))
    assert rows[0]["ap"] == pytest.approx((1 + 2 / 3) / 3) and rows[2]["ap"] is None and rows[4]["ap"] == 0.0
    assert ranking.map_at_k(df, "p", "a").first()[0] == pytest.approx(((1 + 2 / 3) / 3 + 0 + 1 + 0) / 4)
    assert ranking.hit_rate(df, "p", "a").first()[0] == pytest.approx(2 / 5)
    catalog = spark.createDataFrame([("a",), ("b",), ("z",), ("z",)], "item string")
    assert ranking.coverage(df, "p", catalog, "item", 2).first()[0] == pytest.approx(2 / 3)

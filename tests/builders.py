"""Events and raw tables for tests."""

import json

from pyspark.sql import functions as F

from tripfunnel.operators import staging


def search(event_id, at, user="u1", session="s1", query="hotels in miami", **more):
    base = {
        "event_id": event_id, "event_type": "search", "timestamp": at, "user_id": user,
        "session_id": session, "query": query, "results_count": 10, "page": 1, "platform": "web",
        "device_type": "desktop", "geo": {"country": "CA", "city": None}, "utm_source": "google",
        "utm_campaign": "c1",
    }
    return {**base, **more}


def click(event_id, at, search_id, user="u1", session="s1", destination="Miami", **more):
    base = {
        "event_id": event_id, "event_type": "click", "timestamp": at, "user_id": user,
        "session_id": session, "search_event_id": search_id, "result_position": 2,
        "result_id": "r", "result_type": "hotel", "result_price": 100.5,
        "result_provider": "p", "result_destination": destination,
    }
    return {**base, **more}


def conversion(event_id, at, click_id, user="u1", session="s1", value=100.0, **more):
    base = {
        "event_id": event_id, "event_type": "conversion", "timestamp": at, "user_id": user,
        "session_id": session, "click_event_id": click_id, "booking_value": value,
        "commission": round(value * 0.1, 2), "currency": "CAD", "product_type": "hotel",
        "provider": "p",
    }
    return {**base, **more}


def raw_table(spark, documents, ingested="2024-01-01 00:00:00"):
    rows = [(d.get("event_id"), json.dumps(d)) for d in documents]
    df = spark.createDataFrame(rows, "event_id string, payload string")
    return df.withColumn("ingested_at", F.lit(ingested).cast("timestamp"))


def stage_all(spark, documents):
    return tuple(
        staging.stage(raw_table(spark, [d for d in documents if d["event_type"] == kind]), kind)
        for kind in ("search", "click", "conversion")
    )

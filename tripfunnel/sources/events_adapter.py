"""Derives the three JSON event feeds from a generic ``events`` table.

``view`` rows become searches, ``click`` rows clicks and ``purchase`` rows
conversions. Sessions come from gaps, links from the latest preceding search or
click of the same user. Every value is a fixed function of the source row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripfunnel.operators.timeline import carry_forward, sessionize

AS_OF = "2024-01-31 00:00:00"
LINK_HOURS = 24


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    zoneless = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless})


def clickstream(spark: SparkSession, sf_dir: str, gap_minutes: int = 1440) -> DataFrame:
    """Search, click and conversion rows with session number and links."""
    kinds = {"view": "search", "click": "click", "purchase": "conversion"}
    kind = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])[F.col("event_type")]
    # Ties on the clock are read in funnel order.
    step = F.array_position(F.array(*[F.lit(k) for k in kinds]), F.col("event_type"))
    events = (
        read_table(spark, sf_dir, "events")
        .filter(F.col("event_type").isin(*kinds))
        .select(
            F.col("event_id").alias("n"),
            F.col("ts").alias("event_timestamp"),
            "user_id",
            kind.alias("kind"),
            step.alias("step"),
            F.col("value").cast("decimal(10,2)").alias("amount"),
            F.get_json_object("props", "$.k").cast("int").alias("k"),
        )
    )
    seen = F.struct("event_timestamp", "n")
    linked = carry_forward(
        events,
        "user_id",
        "event_timestamp",
        ["step", "n"],
        {
            "last_search": F.when(F.col("kind") == "search", seen),
            "last_click": F.when(F.col("kind") == "click", seen),
        },
    )
    return sessionize(linked, "user_id", "event_timestamp", gap_minutes)


def _link(name: str) -> Column:
    oldest = F.col("event_timestamp") - F.make_dt_interval(hours=F.lit(LINK_HOURS))
    return F.when(F.col(f"{name}.event_timestamp") >= oldest, F.col(f"{name}.n").cast("string"))


def _pick(index: Column, *names: str) -> Column:
    return F.get(F.array(*[F.lit(n) for n in names]), index.cast("int"))


def raw_events(spark: SparkSession, sf_dir: str, gap_minutes: int = 1440) -> DataFrame:
    """``(event_id, kind, payload, ingested_at)``: every event as a JSON document."""
    n, k, kind = F.col("n"), F.col("k"), F.col("kind")
    destination = F.concat(F.lit("dest_"), (k % 15).cast("string"))
    platform = _pick(n % 3, "web", "ios", "android")
    device = F.when(
        platform == "web", _pick(F.floor(n / 3) % 3, "desktop", "mobile", "tablet")
    ).otherwise("mobile")
    source = _pick(n % 4, "google", "facebook", "email")
    commission = (F.col("amount") * F.lit("0.10").cast("decimal(3,2)")).cast("decimal(10,2)")
    product = _pick(k % 4, "flight", "hotel", "car", "package")
    shared = [
        n.cast("string").alias("event_id"),
        kind.alias("event_type"),
        F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        F.when(F.col("user_id") % 10 != 0, F.concat(F.lit("user_"), F.col("user_id").cast("string")))
        .alias("user_id"),
        F.concat_ws("-", F.col("user_id").cast("string"), F.col("session_number").cast("string"))
        .alias("session_id"),
    ]
    search = F.to_json(
        F.struct(
            *shared,
            F.concat(F.lit("  Hotels In "), F.upper(F.lit("dest_")), (k % 15).cast("string"), F.lit(" "))
            .alias("query"),
            (F.lit(10) + k % 91).alias("results_count"),
            F.lit(1).alias("page"),
            platform.alias("platform"),
            device.alias("device_type"),
            F.struct(
                F.when(F.col("user_id") % 2 == 0, "CA").otherwise("US").alias("country"),
                F.lit(None).cast("string").alias("city"),
            ).alias("geo"),
            source.alias("utm_source"),
            F.when(source.isNotNull(), F.concat(F.lit("c"), (n % 5).cast("string")))
            .alias("utm_campaign"),
        ),
        {"ignoreNullFields": "false"},
    )
    click = F.to_json(
        F.struct(
            *shared,
            _link("last_search").alias("search_event_id"),
            (F.lit(1) + k % 8).alias("result_position"),
            F.concat(F.lit("r"), k.cast("string")).alias("result_id"),
            product.alias("result_type"),
            F.col("amount").alias("result_price"),
            F.lit("provider").alias("result_provider"),
            destination.alias("result_destination"),
        ),
        {"ignoreNullFields": "false"},
    )
    conversion = F.to_json(
        F.struct(
            *shared,
            _link("last_click").alias("click_event_id"),
            F.col("amount").alias("booking_value"),
            commission.alias("commission"),
            F.lit("CAD").alias("currency"),
            product.alias("product_type"),
            F.lit("provider").alias("provider"),
        ),
        {"ignoreNullFields": "false"},
    )
    return clickstream(spark, sf_dir, gap_minutes).select(
        n.cast("string").alias("event_id"),
        "kind",
        F.when(kind == "search", search).when(kind == "click", click).otherwise(conversion)
        .alias("payload"),
        F.col("event_timestamp").alias("ingested_at"),
    )

"""Staging: typed, flat and deduplicated events from raw JSON payloads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripfunnel.operators.rows import dedupe_latest
from tripfunnel.sources.raw import fault


@dataclass(frozen=True)
class Field:
    """One staged column: its JSON path (dots for nesting) and its type."""

    name: str
    path: str
    type: str = "string"


def _common(*rest: Field) -> tuple[Field, ...]:
    return (
        Field("event_type", "event_type"),
        Field("event_timestamp", "timestamp", "timestamp"),
        Field("user_id", "user_id"),
        Field("session_id", "session_id"),
        *rest,
    )


SEARCH_FIELDS = _common(
    Field("search_query", "query"),
    Field("results_count", "results_count", "int"),
    Field("page_number", "page", "int"),
    Field("platform", "platform"),
    Field("device_type", "device_type"),
    Field("geo_country", "geo.country"),
    Field("geo_city", "geo.city"),
    Field("utm_source", "utm_source"),
    Field("utm_medium", "utm_medium"),
    Field("utm_campaign", "utm_campaign"),
)

CLICK_FIELDS = _common(
    Field("search_event_id", "search_event_id"),
    Field("result_position", "result_position", "int"),
    Field("result_id", "result_id"),
    Field("result_type", "result_type"),
    Field("result_price", "result_price", "decimal(10,2)"),
    Field("result_provider", "result_provider"),
    Field("result_destination", "result_destination"),
)

CONVERSION_FIELDS = _common(
    Field("click_event_id", "click_event_id"),
    Field("booking_value", "booking_value", "decimal(10,2)"),
    Field("commission", "commission", "decimal(10,2)"),
    Field("currency", "currency"),
    Field("product_type", "product_type"),
    Field("provider", "provider"),
)

FIELDS = {"search": SEARCH_FIELDS, "click": CLICK_FIELDS, "conversion": CONVERSION_FIELDS}


def _text_schema(fields: tuple[Field, ...]) -> str:
    """A schema of strings, so that one pass over the JSON yields every field."""
    flat = [f"`{f.path}` STRING" for f in fields if "." not in f.path]
    nested: dict[str, list[str]] = {}
    for f in fields:
        if "." in f.path:
            parent, child = f.path.split(".")
            nested.setdefault(parent, []).append(f"`{child}`: STRING")
    flat += [f"`{p}` STRUCT<{', '.join(children)}>" for p, children in nested.items()]
    return ", ".join(flat)


def _text(field: Field) -> Column:
    value = F.col("_json")
    for part in field.path.split("."):
        value = value.getField(part)
    return value


def typed_value(field: Field) -> Column:
    if field.name == "search_query":
        return F.lower(F.trim(_text(field)))
    return _text(field) if field.type == "string" else _text(field).try_cast(field.type)


def _cast_errors(fields: tuple[Field, ...]) -> Column:
    """What is wrong with a line: that it is no event, else the names of the fields that
    hold text their type cannot read, or anything but an object where one is declared.
    """
    typed = [
        F.when(_text(f).isNotNull() & _text(f).try_cast(f.type).isNull(), F.lit(f.name))
        for f in fields
        if f.type != "string"
    ]
    parents = sorted({f.path.split(".")[0] for f in fields if "." in f.path})
    nested = [
        F.when(
            F.get_json_object("payload", f"$.{p}").isNotNull() & F.col("_json").getField(p).isNull(), F.lit(p)
        )
        for p in parents
    ]
    no_event = fault(F.col("payload"), F.col("event_id"))
    found = F.filter(F.array(*typed, *nested), lambda name: name.isNotNull())
    return F.when(no_event.isNotNull(), F.array(no_event)).otherwise(found)


def parse(raw: DataFrame, fields: tuple[Field, ...]) -> DataFrame:
    """Adds ``_json`` and ``_errors``. The generator keeps later filters above the parsed
    value: pushed below it, each of their terms would parse the document again.
    """
    parsed = F.from_json("payload", _text_schema(fields))
    return raw.select("*", F.explode_outer(F.array(parsed)).alias("_json")).withColumn(
        "_errors", _cast_errors(fields)
    )


def stage(raw: DataFrame, kind: str) -> DataFrame:
    """Typed rows of one event kind, newest version per ``event_id``.

    Versions that are no JSON events, or hold text that does not fit its type, rank last
    and are not returned; see ``staging_rejects``. Filtering them afterwards leaves one pass over the JSON. Equal
    ``ingested_at`` is settled by the payload's hash: the same winner on every run,
    without moving the payload through the shuffle.
    """
    fields = FIELDS[kind]
    typed = raw.withColumn("_json", F.from_json("payload", _text_schema(fields))).select(
        "event_id",
        *[typed_value(f).alias(f.name) for f in fields],
        "ingested_at",
        (F.size(_cast_errors(fields)) == 0).alias("_valid"),
        F.xxhash64("payload").alias("_tie"),
    )
    latest = dedupe_latest(typed, ["event_id"], ["_valid", "ingested_at", "_tie"])
    return latest.filter("_valid").drop("_valid", "_tie")


def stage_search(raw: DataFrame) -> DataFrame:
    return stage(raw, "search")


def stage_click(raw: DataFrame) -> DataFrame:
    return stage(raw, "click")


def stage_conversion(raw: DataFrame) -> DataFrame:
    return stage(raw, "conversion")


def staging_rejects(raw: DataFrame, kind: str) -> DataFrame:
    """Raw rows that staging refuses, with the fields at fault."""
    return (
        parse(raw, FIELDS[kind])
        .filter(F.size("_errors") > 0)
        .select("event_id", "payload", "ingested_at", F.array_join("_errors", ",").alias("bad_fields"))
    )

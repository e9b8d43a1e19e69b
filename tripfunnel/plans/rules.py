"""The rule set of every model, as data."""

from __future__ import annotations

from tripfunnel.operators.quality import (
    accepted_range,
    accepted_values,
    expression_is_true,
    not_null,
    unique,
)

# The 80 table rules and the freshness limits (hours) per model.
PLATFORMS = ("web", "ios", "android")
DEVICES = ("desktop", "mobile", "tablet")
RESULT_TYPES = ("flight", "hotel", "car", "package")
OUTCOMES = ("converted", "engaged", "bounced")
STAGES = ("searched_only", "clicked", "converted")
SEGMENTS = ("high_value", "at_risk", "abandoned_search", "new_user", "regular")

_RAW = [unique("event_id"), *not_null("event_id", "payload")]

RULES = {
    "raw_search_events": _RAW,
    "raw_click_events": _RAW,
    "raw_conversion_events": _RAW,
    "stg_search_events": [
        unique("event_id"),
        *not_null("event_id", "event_timestamp", "session_id", "search_query"),
        accepted_values("platform", *PLATFORMS),
        accepted_values("device_type", *DEVICES),
    ],
    "stg_click_events": [
        unique("event_id"),
        *not_null("event_id", "search_event_id", "result_position"),
        accepted_range("result_position", 1, 100),
        accepted_values("result_type", *RESULT_TYPES),
    ],
    "stg_conversion_events": [
        unique("event_id"),
        *not_null("event_id", "click_event_id", "booking_value", "commission"),
        accepted_range("booking_value", 0),
        accepted_range("commission", 0),
    ],
    "int_search_sessions": [
        unique("session_id"),
        *not_null("session_id", "search_count"),
        accepted_range("search_count", 1),
        accepted_values("session_outcome", *OUTCOMES),
        accepted_range("session_ctr", 0, 1),
        accepted_range("session_conversion_rate", 0, 1),
        expression_is_true("click_count <= search_count * 10"),
        expression_is_true("conversion_count <= click_count"),
    ],
    "int_user_journeys": [
        *not_null("search_event_id", "session_id"),
        accepted_values("journey_stage", *STAGES),
        accepted_values("is_converted", 0, 1),
        accepted_range("attributed_revenue", 0),
        expression_is_true("journey_stage != 'converted' OR click_event_id IS NOT NULL"),
        expression_is_true("journey_stage != 'clicked' OR click_event_id IS NOT NULL"),
        expression_is_true("attributed_revenue = 0 OR is_converted = 1"),
    ],
    "fct_search_funnel": [
        *not_null("funnel_date", "total_sessions", "total_searches"),
        accepted_range("total_sessions", 0),
        accepted_range("total_searches", 0),
        accepted_range("total_clicks", 0),
        accepted_range("total_conversions", 0),
        accepted_range("click_through_rate", 0, 1),
        accepted_range("conversion_rate", 0, 1),
        expression_is_true("total_clicks <= total_searches * 5"),
        expression_is_true("total_conversions <= total_clicks"),
    ],
    "dim_users": [
        unique("user_id"),
        *not_null("user_id", "first_seen_at", "total_sessions"),
        accepted_range("total_sessions", 1),
        accepted_range("lifetime_revenue", 0),
        accepted_range("lifetime_ctr", 0, 1),
    ],
    "mart_user_segments": [
        unique("user_id"),
        *not_null("user_id", "segment", "engagement_score"),
        accepted_values("segment", *SEGMENTS),
        accepted_range("engagement_score", 0, 100),
        accepted_range("lifetime_revenue", 0),
        accepted_range("lifetime_conversions", 0),
        expression_is_true(
            "segment = 'high_value' OR lifetime_revenue <= 500",
            where="segment != 'high_value' AND lifetime_conversions < 5",
        ),
    ],
    "mart_recommendations": [
        unique("user_id", "recommended_destination"),
        *not_null("user_id", "recommended_destination", "recommendation_score"),
        accepted_range("recommendation_score", 0, 1),
        accepted_range("supporting_users", 1),
        accepted_range("rank", 1, 10),
    ],
}

FRESHNESS_HOURS = {
    "raw_search_events": (1, 6),
    "raw_click_events": (1, 6),
    "raw_conversion_events": (2, 12),
}

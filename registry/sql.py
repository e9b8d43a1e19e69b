"""Building blocks of the SQL twins: the adapted events and the models as CTEs."""

from __future__ import annotations

AS_OF = "2024-01-31 00:00:00"
EARLIER = "2024-01-24 00:00:00"


def ts(literal: str) -> str:
    return f"TIMESTAMP '{literal}'"


def events(gap: int = 1440) -> str:
    """CTEs ``searches``, ``clicks`` and ``conversions`` over the ``events`` table."""
    order = "PARTITION BY uid ORDER BY moment, step, n"
    return f"""
src AS (
  SELECT event_id AS n, ts AS moment, user_id AS uid, CAST(value AS DECIMAL(10,2)) AS amount,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 ELSE 3 END AS step
  FROM events WHERE event_type IN ('view', 'click', 'purchase')),
looked AS (
  SELECT *, lag(moment) OVER ({order}) AS prev_moment,
    last_value(CASE WHEN step = 1 THEN n END IGNORE NULLS) OVER w AS view_n,
    last_value(CASE WHEN step = 1 THEN moment END IGNORE NULLS) OVER w AS view_moment,
    last_value(CASE WHEN step = 2 THEN n END IGNORE NULLS) OVER w AS click_n,
    last_value(CASE WHEN step = 2 THEN moment END IGNORE NULLS) OVER w AS click_moment
  FROM src WINDOW w AS ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
numbered AS (
  SELECT *, CAST(sum(CASE WHEN prev_moment IS NULL OR epoch_us(moment) - epoch_us(prev_moment) > {gap} * 60000000::BIGINT
                 THEN 1 ELSE 0 END)
    OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS session_number
  FROM looked),
feed AS (
  SELECT *, CAST(n AS VARCHAR) AS event_id, moment AS event_timestamp, moment AS ingested_at,
    CASE WHEN uid % 10 <> 0 THEN 'user_' || uid END AS user_id,
    uid || '-' || session_number AS session_id,
    CASE n % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'ios' ELSE 'android' END AS platform,
    CASE n % 4 WHEN 0 THEN 'google' WHEN 1 THEN 'facebook' WHEN 2 THEN 'email' END AS utm_source,
    CASE k % 4 WHEN 0 THEN 'flight' WHEN 1 THEN 'hotel' WHEN 2 THEN 'car' ELSE 'package' END AS product
  FROM numbered),
searches AS (
  SELECT event_id, 'search' AS event_type, event_timestamp, user_id, session_id,
    'hotels in dest_' || (k % 15) AS search_query, CAST(10 + k % 91 AS INTEGER) AS results_count,
    1 AS page_number, platform,
    CASE WHEN platform <> 'web' THEN 'mobile'
         WHEN (n // 3) % 3 = 0 THEN 'desktop' WHEN (n // 3) % 3 = 1 THEN 'mobile'
         ELSE 'tablet' END AS device_type,
    CASE WHEN uid % 2 = 0 THEN 'CA' ELSE 'US' END AS geo_country,
    CAST(NULL AS VARCHAR) AS geo_city, utm_source, CAST(NULL AS VARCHAR) AS utm_medium,
    CASE WHEN utm_source IS NOT NULL THEN 'c' || (n % 5) END AS utm_campaign, ingested_at
  FROM feed WHERE step = 1),
clicks AS (
  SELECT event_id, 'click' AS event_type, event_timestamp, user_id, session_id,
    CASE WHEN view_moment >= moment - INTERVAL 24 HOUR THEN CAST(view_n AS VARCHAR) END AS search_event_id,
    CAST(1 + k % 8 AS INTEGER) AS result_position, 'r' || k AS result_id, product AS result_type,
    amount AS result_price, 'provider' AS result_provider, 'dest_' || (k % 15) AS result_destination,
    ingested_at
  FROM feed WHERE step = 2),
conversions AS (
  SELECT event_id, 'conversion' AS event_type, event_timestamp, user_id, session_id,
    CASE WHEN click_moment >= moment - INTERVAL 24 HOUR THEN CAST(click_n AS VARCHAR) END AS click_event_id,
    amount AS booking_value, CAST(amount * 0.10 AS DECIMAL(10,2)) AS commission, 'CAD' AS currency,
    product AS product_type, 'provider' AS provider, ingested_at
  FROM feed WHERE step = 3)"""


def minutes(later: str, earlier: str) -> str:
    return f"((epoch_us({later}) - epoch_us({earlier})) / 1000000.0::DOUBLE / 60.0::DOUBLE)"


def days(later: str, earlier: str) -> str:
    return f"((epoch_us({later}) - epoch_us({earlier})) / 1000000.0::DOUBLE / 86400.0::DOUBLE)"


def over(num: str, den: str) -> str:
    return f"(CASE WHEN {den} > 0 THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) ELSE 0.0::DOUBLE END)"


def sessions(name: str = "sessions", before: str | None = None) -> str:
    cut = f"WHERE event_timestamp < {ts(before)}" if before else ""
    return f"""
{name}_s AS (
  SELECT session_id, min(event_timestamp) AS session_start, max(event_timestamp) AS session_end,
    count(*) AS search_count, count(DISTINCT search_query) AS unique_queries, max(user_id) AS user_id,
    arg_min({{'p': platform, 'd': device_type, 'g': geo_country, 's': utm_source, 'c': utm_campaign}},
            (event_timestamp, event_id)) AS opening
  FROM searches {cut} GROUP BY session_id),
{name}_c AS (
  SELECT session_id, count(*) AS click_count, avg(result_position) AS avg_click_position
  FROM clicks {cut} GROUP BY session_id),
{name}_v AS (
  SELECT session_id, count(*) AS conversion_count, sum(booking_value) AS booked, sum(commission) AS fee
  FROM conversions {cut} GROUP BY session_id),
{name} AS (
  SELECT s.session_id, s.user_id, session_start, session_end,
    {minutes('session_end', 'session_start')} AS session_duration_minutes,
    search_count, unique_queries, coalesce(click_count, 0) AS click_count,
    coalesce(avg_click_position, 0.0::DOUBLE) AS avg_click_position,
    coalesce(conversion_count, 0) AS conversion_count,
    coalesce(booked, 0) AS total_booking_value, coalesce(fee, 0) AS total_commission,
    opening.p AS platform, opening.d AS device_type, opening.g AS geo_country,
    opening.s AS utm_source, opening.c AS utm_campaign,
    coalesce(click_count, 0)::DOUBLE / search_count AS session_ctr,
    {over('coalesce(conversion_count, 0)', 'coalesce(click_count, 0)')} AS session_conversion_rate,
    CASE WHEN conversion_count > 0 THEN 'converted' WHEN click_count > 0 THEN 'engaged'
         ELSE 'bounced' END AS session_outcome
  FROM {name}_s s LEFT JOIN {name}_c c ON c.session_id = s.session_id
  LEFT JOIN {name}_v v ON v.session_id = s.session_id)"""


JOURNEYS = f"""
journeys AS (
  SELECT s.event_id AS search_event_id, c.event_id AS click_event_id, v.event_id AS conversion_event_id,
    s.user_id, s.session_id, s.event_timestamp AS search_timestamp, s.search_query,
    s.results_count AS search_results_count, s.platform, s.device_type, s.geo_country, s.utm_source,
    s.utm_campaign, c.event_timestamp AS click_timestamp, c.result_position, c.result_type,
    c.result_price, c.result_destination, c.result_provider,
    v.event_timestamp AS conversion_timestamp, v.booking_value, v.commission,
    v.product_type AS converted_product_type,
    round({minutes('c.event_timestamp', 's.event_timestamp')}, 2) AS search_to_click_minutes,
    round({minutes('v.event_timestamp', 'c.event_timestamp')}, 2) AS click_to_conversion_minutes,
    round({minutes('v.event_timestamp', 's.event_timestamp')}, 2) AS search_to_conversion_minutes,
    CASE WHEN v.event_id IS NOT NULL THEN 'converted' WHEN c.event_id IS NOT NULL THEN 'clicked'
         ELSE 'searched_only' END AS journey_stage,
    CASE WHEN v.event_id IS NOT NULL THEN 1 ELSE 0 END AS is_converted,
    coalesce(v.booking_value, 0) AS attributed_revenue, coalesce(v.commission, 0) AS attributed_commission
  FROM searches s LEFT JOIN clicks c ON c.search_event_id = s.event_id
  LEFT JOIN conversions v ON v.click_event_id = c.event_id)"""


def funnel(name: str = "funnel", source: str = "sessions") -> str:
    dims = "platform, device_type, geo_country, utm_source, utm_campaign"
    return f"""
{name} AS (
  SELECT CAST(session_start AS DATE) AS funnel_date, {dims},
    count(DISTINCT session_id) AS total_sessions, CAST(sum(search_count) AS BIGINT) AS total_searches,
    CAST(sum(click_count) AS BIGINT) AS total_clicks,
    CAST(sum(conversion_count) AS BIGINT) AS total_conversions,
    sum(total_booking_value) AS total_revenue, sum(total_commission) AS total_commission,
    {over('sum(click_count)', 'sum(search_count)')} AS click_through_rate,
    {over('sum(conversion_count)', 'sum(click_count)')} AS conversion_rate,
    {over('sum(conversion_count)', 'sum(search_count)')} AS search_to_conversion_rate,
    avg(session_duration_minutes) AS avg_session_duration_minutes,
    avg(avg_click_position) AS avg_click_position, avg(unique_queries) AS avg_queries_per_session,
    {over('sum(total_booking_value)', 'sum(conversion_count)')} AS avg_order_value,
    {over('sum(total_booking_value)', 'count(DISTINCT session_id)')} AS revenue_per_session,
    count(*) FILTER (WHERE session_outcome = 'converted') AS converted_sessions,
    count(*) FILTER (WHERE session_outcome = 'engaged') AS engaged_sessions,
    count(*) FILTER (WHERE session_outcome = 'bounced') AS bounced_sessions
  FROM {source} GROUP BY ALL)"""


def users(name: str = "users", source: str = "sessions", as_of: str = AS_OF) -> str:
    return f"""
{name} AS (
  SELECT user_id, min(session_start) AS first_seen_at, max(session_end) AS last_seen_at,
    {days(ts(as_of), 'max(session_end)')} AS days_since_last_seen,
    {days(ts(as_of), 'min(session_start)')} AS account_age_days,
    count(*) AS total_sessions, CAST(sum(search_count) AS BIGINT) AS lifetime_searches,
    CAST(sum(click_count) AS BIGINT) AS lifetime_clicks,
    CAST(sum(conversion_count) AS BIGINT) AS lifetime_conversions,
    sum(total_booking_value) AS lifetime_revenue, sum(total_commission) AS lifetime_commission,
    max(platform) AS primary_platform, max(device_type) AS primary_device,
    max(geo_country) AS primary_country, avg(session_duration_minutes) AS avg_session_duration,
    avg(session_ctr) AS avg_ctr, avg(session_conversion_rate) AS avg_conversion_rate,
    {over('sum(click_count)', 'sum(search_count)')} AS lifetime_ctr,
    {over('sum(conversion_count)', 'sum(click_count)')} AS lifetime_conversion_rate,
    {over('sum(total_booking_value)', 'count(*)')} AS revenue_per_session,
    {over('sum(total_booking_value)', 'sum(conversion_count)')} AS avg_order_value
  FROM {source} WHERE user_id IS NOT NULL GROUP BY user_id)"""


def segments(
    name: str = "segments", users: str = "users", as_of: str = AS_OF, before: str | None = None
) -> str:
    cut = f"AND event_timestamp < {ts(before)}" if before else ""
    recent = f"event_timestamp >= {ts(as_of)} - INTERVAL 48 HOUR {cut}"
    return f"""
{name} AS (
  SELECT user_id,
    CASE WHEN lifetime_revenue > 500 OR lifetime_conversions >= 5 THEN 'high_value'
         WHEN account_age_days <= 7 THEN 'new_user'
         WHEN days_since_last_seen > 30 AND lifetime_conversions > 0 THEN 'at_risk'
         WHEN user_id IN (SELECT user_id FROM searches WHERE {recent} AND user_id IS NOT NULL)
          AND user_id NOT IN (SELECT user_id FROM conversions WHERE {recent} AND user_id IS NOT NULL)
           THEN 'abandoned_search'
         ELSE 'regular' END AS segment,
    CAST(greatest(0, least(100,
      (CASE WHEN lifetime_conversions > 0 THEN 30 ELSE 0 END) + 3 * least(total_sessions, 10)
      + (CASE WHEN avg_ctr > 0.3 THEN 20 ELSE CAST(avg_ctr * 60 AS INTEGER) END)
      + (CASE WHEN days_since_last_seen < 7 THEN 20 WHEN days_since_last_seen < 14 THEN 15
              WHEN days_since_last_seen < 30 THEN 10 ELSE 0 END))) AS INTEGER) AS engagement_score,
    lifetime_revenue, lifetime_conversions, lifetime_searches, first_seen_at, last_seen_at,
    days_since_last_seen, account_age_days, primary_platform, primary_country,
    {ts(as_of)} AS segmented_at
  FROM {users})"""


AFFINITY = """
affinity AS (
  SELECT c.user_id, c.result_destination AS destination,
    max(CASE WHEN v.event_id IS NOT NULL THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END) AS signal_strength
  FROM clicks c LEFT JOIN conversions v ON v.click_event_id = c.event_id
  WHERE c.user_id IS NOT NULL AND c.result_destination IS NOT NULL GROUP BY ALL)"""

SIMILARITY = """
likeness AS (
  SELECT a.user_id AS ua, b.user_id AS ub, sum(a.signal_strength * b.signal_strength) AS likeness
  FROM affinity a JOIN affinity b ON a.destination = b.destination AND a.user_id <> b.user_id
  GROUP BY ALL HAVING count(*) >= 2)"""

CANDIDATES = """
candidates AS (
  SELECT l.ua AS user_id, t.destination, sum(l.likeness * t.signal_strength) AS raw_score,
         count(DISTINCT l.ub) AS supporting_users
  FROM likeness l JOIN affinity t ON t.user_id = l.ub
  ANTI JOIN affinity seen ON seen.user_id = l.ua AND seen.destination = t.destination
  GROUP BY ALL)"""

RECOMMENDATIONS = f"""
recommendations AS (
  SELECT user_id, destination AS recommended_destination,
    round(raw_score / max(raw_score) OVER (PARTITION BY user_id), 4) AS recommendation_score,
    supporting_users,
    CAST(row_number() OVER (PARTITION BY user_id ORDER BY raw_score DESC, destination) AS INTEGER) AS rank,
    {ts(AS_OF)} AS generated_at
  FROM candidates WHERE raw_score > 1 QUALIFY rank <= 10)"""

_FORMS = {
    "": "{c}",
    "ts": "strftime({c}, '%Y-%m-%d %H:%M:%S.%f')",
    "date": "strftime({c}, '%Y-%m-%d')",
    "num": "round(CAST({c} AS DOUBLE), 6)",
    "int": "CAST({c} AS INTEGER)",
    "big": "CAST({c} AS BIGINT)",
}


def select(columns: str, source: str) -> str:
    """``SELECT`` in the portable form: ``name``, ``name:ts``, ``name:num``, ..."""
    parts = []
    for spec in columns.split():
        name, _, form = spec.partition(":")
        quoted = f'"{name}"'
        parts.append(f"{_FORMS[form].format(c=quoted)} AS {quoted}")
    return f"SELECT {', '.join(parts)} FROM {source}"


def portable_rounding(text: str) -> str:
    """Replaces ``round(x, 6)`` by the same floor expression that the Spark side uses."""
    done, rest = "", text
    while (at := rest.find("round(")) >= 0:
        start, depth = at + len("round("), 1
        end = start
        while depth:
            depth += {"(": 1, ")": -1}.get(rest[end], 0)
            end += 1
        inner = rest[start : end - 1]
        if inner.rstrip().endswith(", 6"):
            value = portable_rounding(inner.rstrip()[: -len(", 6")])
            done += f"{rest[:at]}(floor(CAST({value} AS DOUBLE) * 1000000.0::DOUBLE + 0.5001::DOUBLE) / 1000000.0::DOUBLE)"
        else:
            done += f"{rest[:at]}round({portable_rounding(inner)})"
        rest = rest[end:]
    return done + rest


def query(*ctes: str, final: str) -> str:
    return f"WITH {','.join(ctes)}\n{final}" if ctes else final


MODELS = (events(), sessions(), JOURNEYS, funnel(), users(), segments())
CF = (AFFINITY, SIMILARITY, CANDIDATES, RECOMMENDATIONS)

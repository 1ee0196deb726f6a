"""The queries as SQL for a second engine, written from the meaning of each operator.

A query's SQL is a chain of named blocks; `_with` puts the blocks a final SELECT needs in front
of it.
"""

from __future__ import annotations

import math
import re

from plazaflow.config import DEFAULT_HOUR_WEIGHTS, DEFAULT_ROUTE, METRES_PER_DEGREE, EventConfig
from plazaflow.functions.geo import area_of_interest
from plazaflow.plans.oracle_cells import h3_cells
from plazaflow.plans.queries import DAY
from plazaflow.plans.testdata import PER_DOCUMENT, SALT

EVENT = EventConfig(day=DAY)
MX, MY, EDGE = EVENT.metres_per_degree_lon, METRES_PER_DEGREE, EVENT.cell_edge_m
SQRT3 = math.sqrt(3.0)


def _num(v: float) -> str:
    return f"{v!r}e0"


def _lat(key: str) -> str:
    return f"52.50e0 + ({key} * 7919 % 1000) / 100000e0"


def _lon(key: str) -> str:
    return f"13.36e0 + ({key} * 104729 % 1000) / 100000e0"


def _text(v: str) -> str:
    return f"CAST({v} AS VARCHAR)"


def _time(v: str) -> str:
    return f"strftime({v}, '%Y-%m-%d %H:%M:%S')"


def _day(v: str) -> str:
    return f"strftime({v}, '%Y-%m-%d')"


def _celled(block: str) -> str:
    """All columns of a block with lat and lon, plus the cell."""
    return f"""
    SELECT * EXCLUDE (x_, y_, qf_, rf_, sf_, q_, r_, s_, dq_, dr_, ds_),
      CASE WHEN lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180 THEN concat(
        CAST(CASE WHEN dq_ > dr_ AND dq_ > ds_ THEN -r_ - s_ ELSE q_ END AS BIGINT), '_',
        CAST(CASE WHEN NOT (dq_ > dr_ AND dq_ > ds_) AND dr_ > ds_ THEN -q_ - s_ ELSE r_ END
             AS BIGINT)) END AS h3_index
    FROM (
      SELECT *, lon * {_num(MX)} AS x_, lat * {_num(MY)} AS y_,
        ({_num(SQRT3 / 3.0)} * x_ - y_ / 3e0) / {_num(EDGE)} AS qf_,
        ({_num(2.0 / 3.0)} * y_) / {_num(EDGE)} AS rf_, -qf_ - rf_ AS sf_,
        floor(qf_ + 0.5e0) AS q_, floor(rf_ + 0.5e0) AS r_, floor(sf_ + 0.5e0) AS s_,
        abs(q_ - qf_) AS dq_, abs(r_ - rf_) AS dr_, abs(s_ - sf_) AS ds_
      FROM {block})"""


K = "CAST(json_extract_string(props, '$.k') AS INT)"
DELAY = "CAST(floor(value) AS INT) - 60"
SERVICE = "concat(substr(o_orderpriority, 1, 1), '_', o_custkey % 40)"
NEXT_DAY = f"TIMESTAMP '{DAY}' + INTERVAL 1 DAY"

BLOCKS = {
    "mention_rows": f"""
    SELECT printf('men_%06d', event_id) AS mention_id, date_trunc('second', ts) AS event_ts,
      {_lat('event_id')} AS lat, {_lon('event_id')} AS lon, event_type AS platform,
      CASE event_id % 3 WHEN 0 THEN 'de' WHEN 1 THEN 'en' ELSE 'pl' END AS language,
      {K} / 64e0 - 1e0 AS sentiment, event_id % 5 < 2 AS has_media,
      substr(sha256(concat('{SALT}:', user_id)), 1, 16) AS user_hash, 'synthetic' AS source
    FROM events""",
    "mentions_s": "SELECT *, CAST(hour(event_ts) AS INT) AS hour_of_day FROM ("
    + _celled("mention_rows")
    + ")",
    "far_mentions": """
    SELECT mention_id, lat, lon, (n * 7919 % 179999) / 1000e0 - 90e0 AS far_lat,
      (n * 104729 % 359999) / 1000e0 - 180e0 AS far_lon
    FROM (SELECT *, CAST(substr(mention_id, 5) AS BIGINT) AS n FROM mention_rows)""",
    "mentions_h3": "SELECT *, CAST(hour(event_ts) AS INT) AS hour_of_day FROM "
    + h3_cells("mention_rows", 8),
    "activity_h3": """
    SELECT h3_index, hour_of_day, count(*) AS num_mentions,
      count(DISTINCT user_hash) AS num_users, avg(sentiment) AS avg_sentiment,
      avg(CASE WHEN has_media THEN 1e0 ELSE 0e0 END) AS pct_with_media
    FROM mentions_h3 GROUP BY ALL""",
    "updates": f"""
    SELECT {_text('event_id % 97')} AS trip_id, {_text('user_id % 25')} AS route_id,
      {_text('user_id')} AS stop_id, {DELAY} AS delay_seconds, date_trunc('hour', ts) AS feed_ts
    FROM events WHERE event_type <> 'signup'
    UNION ALL
    SELECT {_text('event_id % 97')}, {_text('user_id % 25')}, {_text('user_id + 37')},
      {DELAY} + 15, date_trunc('hour', ts)
    FROM events WHERE event_type <> 'signup'""",
    "stop_delays": """
    SELECT * FROM updates QUALIFY row_number() OVER (
      PARTITION BY trip_id, stop_id, feed_ts ORDER BY delay_seconds DESC, route_id DESC) = 1""",
    "stop_rows": f"""
    SELECT {_text('s_suppkey')} AS stop_id, s_name AS stop_name,
      CASE WHEN s_nationkey % 2 = 0 THEN {_text('s_suppkey')}
           ELSE concat('S', s_nationkey) END AS station_id,
      {_lat('s_suppkey')} AS lat, {_lon('s_suppkey')} AS lon FROM supplier""",
    "places": _celled("stop_rows"),
    "delays_s": """
    SELECT d.*, p.lat, p.lon, p.h3_index FROM stop_delays d LEFT JOIN places p USING (stop_id)""",
    "readings": f"""
    SELECT {_text('user_id')} AS station_id, {K} AS num_bikes_available,
      100 - {K} AS num_docks_available, 1 AS is_renting,
      CAST(event_id % 2 AS INT) AS is_returning, date_trunc('hour', ts) AS reading_ts
    FROM events QUALIFY row_number() OVER (
      PARTITION BY user_id, date_trunc('hour', ts)
      ORDER BY num_bikes_available DESC, is_returning DESC) = 1""",
    "bike_station_rows": f"""
    SELECT {_text('s_suppkey')} AS station_id, {_lat('s_suppkey')} AS lat,
      {_lon('s_suppkey')} AS lon, 21 + s_nationkey AS capacity FROM supplier""",
    "bike_stations": _celled("bike_station_rows"),
    "bikes_s": "SELECT * FROM readings JOIN bike_stations USING (station_id)",
    "pass_rows": """
    SELECT CAST(l_orderkey AS VARCHAR) AS trip_id, CAST(l_suppkey AS VARCHAR) AS stop_id,
      l_linenumber AS stop_sequence,
      printf('%02d:%02d:00', (l_partkey + l_linenumber) % 30, l_partkey % 60) AS hora_programada,
      CAST(((l_partkey + l_linenumber) % 30) % 24 AS INT) AS scheduled_hour
    FROM lineitem WHERE l_partkey % 34 <> 0""",
    "passes": """
    SELECT * FROM pass_rows QUALIFY row_number() OVER (
      PARTITION BY trip_id, stop_id, stop_sequence ORDER BY hora_programada) = 1""",
    "trip_rows": f"""
    SELECT {_text('o_orderkey')} AS trip_id, {_text('o_custkey % 30')} AS route_id,
      {SERVICE} AS service_id FROM orders""",
    "line_rows": f"""
    SELECT {_text('n_nationkey')} AS route_id, n_name AS route_name,
      CASE n_regionkey WHEN 0 THEN '700' WHEN 1 THEN '109' WHEN 2 THEN '900'
        WHEN 3 THEN '400' ELSE '1501' END AS route_type,
      CASE n_regionkey WHEN 0 THEN 'bus' WHEN 1 THEN 'sbahn' WHEN 2 THEN 'tram'
        WHEN 3 THEN 'ubahn' ELSE 'otro' END AS transport_mode FROM nation""",
    "services": f"SELECT DISTINCT {SERVICE} AS service_id, o_custkey % 40 AS n FROM orders",
    "active": """
    SELECT service_id FROM services
    WHERE ((n % 4 <> 0 AND n % 5 <> 0) OR n % 8 = 4) AND n % 7 <> 0""",
    "running": """
    SELECT t.trip_id, t.route_id, t.service_id, l.route_name, l.route_type,
      coalesce(l.transport_mode, 'otro') AS transport_mode
    FROM trip_rows t SEMI JOIN active USING (service_id) LEFT JOIN line_rows l USING (route_id)""",
    "supply": """
    SELECT *, 'real' AS source
    FROM passes JOIN running USING (trip_id) JOIN places USING (stop_id)""",
    "feature_rows": f"""
    SELECT CASE WHEN o_orderkey % 50 = 0 THEN '' ELSE concat('D', o_orderkey) END AS disruption_id,
      o_orderkey, o_orderpriority AS subtype, CAST(NULL AS VARCHAR) AS severity,
      concat('Street ', o_custkey % 100) AS street, CAST(NULL AS VARCHAR) AS section,
      CAST(NULL AS VARCHAR) AS content, o_orderstatus AS object_state,
      o_orderdate AS published_ts,
      CASE WHEN o_orderkey % 10 <> 0 THEN o_orderdate END AS valid_from,
      CAST(CAST(o_orderdate AS DATE) + CAST(o_custkey % 60 AS INT) AS TIMESTAMP) AS valid_to,
      CASE WHEN o_orderkey % 4 < 2 THEN {_lon('o_orderkey')} END AS lon,
      CASE WHEN o_orderkey % 4 < 2 THEN {_lat('o_orderkey')} END AS lat
    FROM orders""",
    "latest_features": """
    SELECT * EXCLUDE (o_orderkey) FROM feature_rows QUALIFY row_number() OVER (
      PARTITION BY disruption_id ORDER BY published_ts DESC NULLS LAST, subtype DESC NULLS LAST,
        street DESC NULLS LAST, object_state DESC NULLS LAST, valid_from DESC NULLS LAST,
        valid_to DESC NULLS LAST, lon DESC NULLS LAST, lat DESC NULLS LAST) = 1""",
    "disruptions_s": _celled("latest_features"),
    "bikes_ch": """
    SELECT h3_index, CAST(hour(reading_ts) AS INT) AS hour_of_day,
      avg(num_bikes_available) AS avg_bikes_available,
      avg(num_docks_available) AS avg_docks_available, count(*) AS num_bike_readings
    FROM bikes_s GROUP BY ALL""",
    "delays_ch": """
    SELECT h3_index, CAST(hour(feed_ts) AS INT) AS hour_of_day,
      avg(delay_seconds) AS avg_delay_seconds,
      avg(CASE WHEN delay_seconds <= 60 THEN 1e0 ELSE 0e0 END) AS pct_on_time,
      count(*) AS num_delay_updates
    FROM delays_s WHERE h3_index IS NOT NULL GROUP BY ALL""",
    "pressure": "SELECT * FROM bikes_ch FULL JOIN delays_ch USING (h3_index, hour_of_day)",
    "reliability": """
    SELECT route_id, CAST(feed_ts AS DATE) AS service_date,
      CAST(hour(feed_ts) AS INT) AS hour_of_day, avg(delay_seconds) AS avg_delay_seconds,
      avg(CASE WHEN delay_seconds <= 60 THEN 1e0 ELSE 0e0 END) AS pct_on_time,
      count(*) AS num_updates
    FROM delays_s GROUP BY ALL""",
    "capacity": """
    SELECT h3_index, scheduled_hour, transport_mode, count(*) AS num_scheduled_stops,
      count(DISTINCT route_name) AS num_routes, count(DISTINCT station_id) AS num_stations
    FROM supply WHERE h3_index IS NOT NULL GROUP BY ALL""",
    "capacity_all": """
    SELECT h3_index, scheduled_hour AS hour_of_day,
      CAST(sum(num_scheduled_stops) AS BIGINT) AS num_scheduled_stops,
      CAST(sum(num_routes) AS BIGINT) AS num_routes_all_modes
    FROM capacity GROUP BY ALL""",
    "station_lines": """
    SELECT station_id, transport_mode, route_name,
      min(struct_pack(n := stop_name, c := h3_index)) AS place,
      count(*) AS num_scheduled_stops, min(scheduled_hour) AS first_hour,
      max(scheduled_hour) AS last_hour
    FROM supply GROUP BY ALL""",
    "activity_all": """
    SELECT h3_index, hour_of_day, count(*) AS num_mentions,
      count(DISTINCT user_hash) AS num_users, avg(sentiment) AS avg_sentiment,
      avg(CASE WHEN has_media THEN 1e0 ELSE 0e0 END) AS pct_with_media
    FROM mentions_s WHERE h3_index IS NOT NULL GROUP BY ALL""",
    "slots": """
    SELECT *, CAST(service_date AS TIMESTAMP) + to_hours(hour_of_day) AS slot_ts
    FROM reliability""",
    "lagged": """
    SELECT *, lag(slot_ts) OVER w AS previous_slot_ts,
      lag(avg_delay_seconds) OVER w AS delay_lag_seconds,
      lag(pct_on_time) OVER w AS pct_on_time_lag,
      lag(num_updates) OVER w AS num_updates_lag,
      (epoch(slot_ts) - epoch(previous_slot_ts)) / 3600e0 AS gap_hours
    FROM slots WINDOW w AS (PARTITION BY route_id ORDER BY slot_ts)""",
    "training": """
    SELECT *, CAST(dayofweek(service_date) + 1 AS INT) AS day_of_week FROM lagged
    WHERE delay_lag_seconds IS NOT NULL""",
    "ranked_slots": """
    SELECT slot_ts, row_number() OVER (ORDER BY slot_ts) AS i, count(*) OVER () AS n
    FROM (SELECT DISTINCT slot_ts FROM training)""",
    "cut": """
    SELECT slot_ts AS cut_ts FROM ranked_slots
    WHERE i = greatest(1, least(CAST(floor(n * 0.8e0) AS BIGINT), n - 1))""",
    "wide_stop_rows": f"""
    SELECT {_text('s_suppkey')} AS stop_id,
      CASE WHEN s_suppkey % 41 <> 0 THEN 52.40e0 + (s_suppkey * 7919 % 1000) / 4000e0 END AS lat,
      13.30e0 + (s_suppkey * 104729 % 1000) / 4000e0 AS lon FROM supplier""",
    "near_stops": """
    SELECT * FROM wide_stop_rows
    WHERE lat BETWEEN {} AND {} AND lon BETWEEN {} AND {}""".format(
        *[_num(v) for v in area_of_interest(EVENT)]
    ),
    "near_times": """
    SELECT * FROM lineitem
    WHERE CAST(l_suppkey AS VARCHAR) IN (SELECT stop_id FROM near_stops)""",
    "near_trips": """
    SELECT * FROM trip_rows
    WHERE trip_id IN (SELECT CAST(l_orderkey AS VARCHAR) FROM near_times)""",
    "exceptions": f"""
    SELECT service_id, '{EVENT.compact_day}' AS date, '2' AS exception_type
    FROM services WHERE n % 7 = 0
    UNION ALL SELECT service_id, '{EVENT.compact_day}', '1' FROM services WHERE n % 8 = 4
    UNION ALL SELECT service_id, '{DAY.year}0103', '2' FROM services WHERE n % 3 = 0""",
    "near_exceptions": """
    SELECT * FROM exceptions WHERE service_id IN (SELECT service_id FROM near_trips)""",
    "joined": """
    SELECT a.*, p.* EXCLUDE (h3_index, hour_of_day), c.* EXCLUDE (h3_index, hour_of_day),
      num_mentions / CAST(nullif(num_scheduled_stops, 0) AS DOUBLE) AS mentions_per_scheduled_stop
    FROM (SELECT * FROM activity_all WHERE num_mentions >= 5) a
    LEFT JOIN pressure p USING (h3_index, hour_of_day)
    LEFT JOIN capacity_all c USING (h3_index, hour_of_day)""",
}


def _with(select: str) -> str:
    """Puts the blocks a SELECT refers to, directly or not, in front of it."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in BLOCKS:
            if name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+\(?{name}\b", sql):
                visit(BLOCKS[name])
                if name not in needed:
                    needed.append(name)

    visit(select)
    head = ",\n".join(f"{name} AS ({BLOCKS[name]})" for name in needed)
    return f"WITH {head}\n{select}" if needed else select


def _r(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


PRESSURE = "num_bike_readings, num_delay_updates, " + _r(
    "avg_bikes_available", "avg_docks_available", "avg_delay_seconds", "pct_on_time"
)
ACTIVITY = "h3_index, hour_of_day, num_mentions, num_users, " + _r(
    "avg_sentiment", "pct_with_media"
)
RELIABILITY = f"route_id, {_day('service_date')} AS service_date, hour_of_day, num_updates, " + _r(
    "avg_delay_seconds", "pct_on_time"
)
LAGS = "num_updates_lag, " + _r("delay_lag_seconds", "pct_on_time_lag", "gap_hours")
DELAYS = (
    f"stop_id, trip_id, route_id, delay_seconds, {_time('feed_ts')} AS feed_ts, h3_index, "
    + _r("lat", "lon")
)
SUPPLY = (
    "stop_id, route_id, service_id, trip_id, stop_sequence, hora_programada, scheduled_hour,"
    " route_name, route_type, stop_name, station_id, transport_mode, source, h3_index, "
    + _r("lat", "lon")
)
SERVICES = (
    "station_id, transport_mode, route_name, place.n AS station_name, place.c AS h3_index,"
    " num_scheduled_stops, first_hour, last_hour"
)


def _mentions_sql() -> str:
    """Generated mentions, from the same digests."""

    def u(digest: str, part: int) -> str:
        word = f"CAST(concat('0x', substr({digest}, {1 + 8 * part}, 8)) AS BIGINT)"
        return f"((CAST({word} AS DOUBLE) + 0.5e0) / 4294967296e0)"

    def digest(name: str) -> str:
        return f"md5(concat('{EVENT.seed}:{name}:', event_id))"

    def choose(v: str, values) -> str:
        return "CASE {} {} END".format(
            f"CAST(floor({v} * {len(values)}) AS INT)",
            " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(values)),
        )

    reached, hours, total = 0, [], sum(DEFAULT_HOUR_WEIGHTS)
    for hour, weight in enumerate(DEFAULT_HOUR_WEIGHTS):
        if weight:
            reached += weight
            hours.append(f"WHEN {u('d2', 0)} * {total} < {reached} THEN {hour}")
    two_pi = _num(2.0 * math.pi)
    r1 = f"sqrt(-2e0 * ln({u('d1', 1)}))"
    r3 = f"sqrt(-2e0 * ln({u('d3', 0)}))"
    places = range(len(DEFAULT_ROUTE))
    lat0 = choose(u("d1", 0), [_num(DEFAULT_ROUTE[i][0]) for i in places])
    lon0 = choose(u("d1", 0), [_num(DEFAULT_ROUTE[i][1]) for i in places])
    mood = f"{r3} * cos({u('d3', 1)} * {two_pi})"
    return f"""
    SELECT printf('men_%06d', event_id) AS mention_id,
      printf('{DAY}T%02d:%02d:%02d', CASE {' '.join(hours)} END,
        CAST(floor({u('d2', 1)} * 60) AS INT), CAST(floor({u('d2', 2)} * 60) AS INT)) AS event_ts,
      round({lat0} + {r1} * cos({u('d1', 2)} * {two_pi}) * 300e0 / {_num(MY)}, 6) AS lat,
      round({lon0} + {r1} * sin({u('d1', 2)} * {two_pi}) * 300e0 / {_num(MX)}, 6) AS lon,
      {choose(u('d1', 3), ["'mastodon'", "'bluesky'", "'x'"])} AS platform,
      {choose(u('d2', 3), ["'de'", "'en'", "'pl'"])} AS language,
      round(greatest(-1e0, least(1e0, 0.35e0 + 0.4e0 * ({mood}))), 3) + 0e0 AS sentiment,
      {u('d3', 2)} < 0.4e0 AS has_media,
      substr(sha256(concat('{SALT}:', CAST(floor({u('d3', 3)} * 400) AS INT))), 1, 16) AS user_hash
    FROM (SELECT event_id, {digest('place')} AS d1, {digest('time')} AS d2,
            {digest('text')} AS d3 FROM events)"""


def _doc(key: str) -> str:
    return f"concat('doc-', {key} // {PER_DOCUMENT})"


def _errors(actual: str, predicted: str) -> str:
    off = f"({predicted} - {actual})"
    return (
        f"round(avg(abs{off}), 2) AS mae_seconds,"
        f" round(sqrt(avg({off} * {off})), 2) AS rmse_seconds"
    )


SELECTS = {
    "provenance_tags": """SELECT 'synthetic' AS source, event_type AS platform,
        count(*) AS num_rows, count(*) AS num_stamped FROM events GROUP BY event_type""",
    "bronze_append": """SELECT CAST(user_id AS VARCHAR) AS station_id, source,
        count(*) AS num_rows FROM events, (VALUES ('real'), ('synthetic')) v(source)
        GROUP BY user_id, source""",
    "bronze_snapshot": """SELECT CAST(s_suppkey AS VARCHAR) AS stop_id, s_name AS stop_name,
        'P' AS platform_code, 'real' AS source FROM supplier""",
    "feed_envelope_explode": f"""SELECT CAST(user_id AS VARCHAR) AS station_id,
        {_doc('event_id')} AS source_url, '1700000000' AS feed_last_updated, {K} AS num_bikes
        FROM events""",
    "trip_update_entities": f"""SELECT concat('e', event_id) AS entity_id,
        '1700000000' AS feed_timestamp, {_doc('event_id')} AS source_url,
        CAST(event_id % 97 AS VARCHAR) AS trip_id
        FROM events WHERE event_type NOT IN ('error', 'view')""",
    "feed_url_lookup": """SELECT concat('doc-', s_suppkey) AS source_url,
        concat('u/', CASE WHEN s_nationkey % 2 = 0 THEN 'en' ELSE 'de' END, '/status/', s_suppkey)
          AS url FROM supplier""",
    "geojson_points": f"""SELECT disruption_id, {_doc('o_orderkey')} AS source_url,
        {_r('lon', 'lat')} FROM feature_rows""",
    "timetable_file_scan": """SELECT CAST(s_suppkey AS VARCHAR) AS stop_id, s_name AS stop_name,
        CASE WHEN s_nationkey % 2 = 1 THEN concat('S', s_nationkey) END AS parent_station,
        CAST(NULL AS VARCHAR) AS zone_id FROM supplier""",
    "pseudonymised_users": f"""SELECT substr(sha256(concat('{SALT}:', user_id)), 1, 16)
        AS user_hash, count(*) AS num_events FROM events GROUP BY user_id""",
    "generated_mentions": _mentions_sql(),
    "stream_ingest": f"""SELECT * REPLACE (strftime(event_ts, '%Y-%m-%dT%H:%M:%S') AS event_ts,
        {_r('lat')}, {_r('lon')}, {_r('sentiment')}) FROM mention_rows""",
    "stream_replays_and_rejects": """
    SELECT 'kept' AS kind, count(*) AS num_rows, count(*) AS num_ids, count(*) FILTER (p <> 4) AS num_lat
      FROM (SELECT CAST(substr(mention_id, 5) AS BIGINT) % 5 AS p FROM mention_rows)
    UNION ALL SELECT CASE p WHEN 2 THEN 'no id' WHEN 4 THEN 'field' ELSE 'broken' END,
      CAST(sum(CASE WHEN p IN (1, 2) THEN 2 ELSE 1 END) AS BIGINT), 0, 0
      FROM (SELECT CAST(substr(mention_id, 5) AS BIGINT) % 5 AS p FROM mention_rows) WHERE p > 0 GROUP BY 1""",
    "sql_distinct_services": f"""SELECT count(*) AS num_services, '{DAY.year}0101' AS first_day,
        max(CASE WHEN n % 5 = 0 THEN '{DAY.year}0102' ELSE '{DAY.year}1231' END) AS last_day
        FROM services""",
    "silver_kept_up": """SELECT unnest(['silver_bike_availability', 'silver_transit_delays',
        'silver_csd_mentions']) AS table_name, 'days' AS mode, 0 AS num_differences, TRUE AS read_less_than_all""",
    "filtered_passes": "SELECT count(*) AS num_rows, TRUE AS few_too_many FROM near_times",
    "placed_stops_scan": f"SELECT stop_id, {_r('lat', 'lon')} FROM near_stops",
    "people_over_cells": """SELECT coalesce(hour_of_day, -1) AS hour_of_day, count(*) AS num_mentions,
        count(DISTINCT user_hash) AS num_users, TRUE AS estimate_is_near
        FROM mentions_s WHERE h3_index IS NOT NULL GROUP BY ROLLUP (hour_of_day)""",
    "bbox_stops": f"SELECT stop_id, {_r('lat', 'lon')} FROM near_stops",
    "timetable_semijoin_cascade": """
        SELECT 'stops' AS table_name, count(*) AS num_rows FROM near_stops
        UNION ALL SELECT 'stop_times', count(*) FROM near_times
        UNION ALL SELECT 'trips', count(*) FROM near_trips
        UNION ALL SELECT 'routes', count(*) FROM line_rows
          WHERE route_id IN (SELECT route_id FROM near_trips)
        UNION ALL SELECT 'calendar', count(*) FROM services
          WHERE service_id IN (SELECT service_id FROM near_trips)
        UNION ALL SELECT 'calendar_dates', count(*) FROM near_exceptions""",
    "cascade_trips": "SELECT trip_id, route_id, service_id FROM near_trips",
    "cascade_exceptions": "SELECT service_id, date, exception_type FROM near_exceptions",
    "json_payload_parse": f"SELECT * REPLACE ({_time('reading_ts')} AS reading_ts) FROM readings",
    "trip_update_flatten": f"SELECT * REPLACE ({_time('feed_ts')} AS feed_ts) FROM stop_delays",
    "scheduled_passes": "SELECT * FROM passes",
    "active_service_ids": "SELECT service_id FROM active",
    "active_without_exceptions": "SELECT service_id FROM services WHERE n % 4 <> 0 AND n % 5 <> 0",
    "running_trip_modes": "SELECT * FROM running",
    "hex_cells": "SELECT mention_id, h3_index FROM mentions_s",
    "h3_cells": "SELECT mention_id, h3_index, far_wide, far, TRUE AS center_is_inside FROM "
    + h3_cells(h3_cells(h3_cells("far_mentions", 9), 3, "far_lat", "far_lon", "far_wide"), 6, "far_lat", "far_lon", "far"),
    "mentions_by_h3_cell": f"SELECT {ACTIVITY} FROM activity_h3",
    "cell_centers": f"""SELECT h3_index,
        round({_num(EDGE * 1.5)} * r / {_num(MY)}, 6) AS lat,
        round({_num(EDGE * SQRT3)} * (q + r / 2e0) / {_num(MX)}, 6) AS lon
        FROM (SELECT DISTINCT h3_index, CAST(split_part(h3_index, '_', 1) AS DOUBLE) AS q,
                CAST(split_part(h3_index, '_', 2) AS DOUBLE) AS r FROM mentions_s)""",
    "silver_bikes": f"""SELECT station_id, num_bikes_available, num_docks_available, is_renting,
        is_returning, {_time('reading_ts')} AS reading_ts, {_r('lat', 'lon')}, capacity, h3_index
        FROM bikes_s""",
    "silver_delays": f"SELECT {DELAYS} FROM delays_s",
    "silver_disruptions": f"""SELECT * REPLACE ({_time('published_ts')} AS published_ts,
        {_time('valid_from')} AS valid_from, {_time('valid_to')} AS valid_to,
        {_r('lon')}, {_r('lat')}) FROM disruptions_s""",
    "silver_supply": f"SELECT {SUPPLY} FROM supply",
    "silver_mentions": f"""SELECT * REPLACE ({_time('event_ts')} AS event_ts, {_r('lat')},
        {_r('lon')}, {_r('sentiment')}) FROM mentions_s""",
    "mobility_pressure": f"SELECT h3_index, hour_of_day, {PRESSURE} FROM pressure",
    "line_reliability": f"SELECT {RELIABILITY} FROM reliability",
    "disruptions_by_cell": f"""SELECT h3_index, count(*) AS num_disruptions FROM disruptions_s
        WHERE valid_from < {NEXT_DAY} AND valid_to >= TIMESTAMP '{DAY}' AND h3_index IS NOT NULL
        GROUP BY h3_index""",
    "disruptions_open_ended": f"""SELECT h3_index, count(*) AS num_disruptions FROM disruptions_s
        WHERE coalesce(valid_from < {NEXT_DAY}, true)
          AND coalesce(valid_to >= TIMESTAMP '{DAY}', true)
          AND h3_index IS NOT NULL GROUP BY h3_index""",
    "station_services": f"SELECT {SERVICES} FROM station_lines",
    "transit_capacity": "SELECT * FROM capacity",
    "capacity_all_modes": "SELECT * FROM capacity_all",
    "mentions_by_cell_hour": f"SELECT {ACTIVITY} FROM activity_all",
    "csd_activity": f"SELECT {ACTIVITY} FROM activity_all WHERE num_mentions >= 5",
    "activity_k_users": f"SELECT {ACTIVITY} FROM activity_all WHERE num_users >= 5",
    "k_anonymity_effect": """SELECT 20 AS k, count(*) FILTER (num_mentions >= 20)
          AS published_cell_hours,
        count(*) FILTER (num_mentions < 20) AS suppressed_cell_hours,
        CAST(coalesce(sum(num_mentions) FILTER (num_mentions < 20), 0) AS BIGINT)
          AS suppressed_mentions,
        coalesce(round(100e0 * coalesce(sum(num_mentions) FILTER (num_mentions < 20), 0)
          / nullif(sum(num_mentions), 0), 1), 0e0) AS pct_mentions_suppressed FROM activity_all""",
    "mobility_vs_activity": f"""SELECT {ACTIVITY}, {PRESSURE}, num_scheduled_stops,
        num_routes_all_modes, {_r('mentions_per_scheduled_stop')} FROM joined""",
    "previous_slot_features": f"""SELECT {RELIABILITY}, {_time('slot_ts')} AS slot_ts,
        {_time('previous_slot_ts')} AS previous_slot_ts, {LAGS} FROM lagged""",
    "training_features": f"""SELECT route_id, {_day('service_date')} AS service_date,
        {_time('slot_ts')} AS slot_ts, hour_of_day, day_of_week, {LAGS},
        {_r('avg_delay_seconds')} FROM training""",
    "scoring_features": f"""SELECT route_id, {_day('ahead')} AS service_date,
        {_time('ahead')} AS slot_ts, CAST(hour(ahead) AS INT) AS hour_of_day,
        CAST(dayofweek(ahead) + 1 AS INT) AS day_of_week,
        round(avg_delay_seconds, 6) AS delay_lag_seconds,
        round(pct_on_time, 6) AS pct_on_time_lag,
        num_updates AS num_updates_lag, 1e0 AS gap_hours
        FROM (SELECT *, slot_ts + INTERVAL 1 HOUR AS ahead FROM slots
              QUALIFY row_number() OVER (PARTITION BY route_id ORDER BY slot_ts DESC) = 1)""",
    "temporal_split": f"""SELECT CASE WHEN slot_ts <= (SELECT cut_ts FROM cut) THEN 'train'
          ELSE 'validation' END AS part,
        count(*) AS num_rows, {_time('min(slot_ts)')} AS first_slot,
        {_time('max(slot_ts)')} AS last_slot FROM training GROUP BY part""",
    "persistence_baseline": f"""SELECT {_errors('avg_delay_seconds', 'delay_lag_seconds')}
        FROM training WHERE slot_ts > (SELECT cut_ts FROM cut)""",
    "model_metrics": f"""SELECT part, num_rows, num_lines, first_slot, last_slot,
        CASE WHEN part = 'baseline' THEN mae_seconds END AS mae_seconds,
        CASE WHEN part = 'baseline' THEN rmse_seconds END AS rmse_seconds,
        CASE WHEN part = 'validation' THEN true END AS better_than_baseline
        FROM (SELECT unnest(CASE WHEN slot_ts <= (SELECT cut_ts FROM cut) THEN ['training']
            ELSE ['validation', 'baseline'] END) AS part, count(*) AS num_rows,
          count(DISTINCT route_id) AS num_lines, {_time('min(slot_ts)')} AS first_slot,
          {_time('max(slot_ts)')} AS last_slot,
          {_errors('avg_delay_seconds', 'delay_lag_seconds')} FROM training GROUP BY 1)""",
    "delay_predictions": f"""SELECT route_id, {_time('ahead')} AS predicted_for_ts,
        CAST(hour(ahead) AS INT) AS hour_of_day,
        round(avg_delay_seconds, 6) AS last_observed_delay_seconds, 'real' AS source,
        true AS within_targets
        FROM (SELECT *, slot_ts + INTERVAL 1 HOUR AS ahead FROM slots
              QUALIFY row_number() OVER (PARTITION BY route_id ORDER BY slot_ts DESC) = 1)""",
    "lake_inventory": """
        SELECT 'bronze' AS layer, 'bronze_csd_mentions' AS table_name, 2 * count(*) AS num_rows,
          12 AS num_columns, 2 AS num_delta_versions FROM events
        UNION ALL SELECT 'silver', 'silver_csd_mentions', count(*), 12, 1 FROM events""",
    "lake_breakdowns": """
        SELECT 'date' AS kind, CAST(CAST(event_ts AS DATE) AS VARCHAR) AS axis, count(*) AS num_rows
          FROM mentions_s GROUP BY 2
        UNION ALL SELECT 'hour', CAST(hour_of_day AS VARCHAR), count(*) FROM mentions_s GROUP BY 2""",
    "lake_station_versions": """SELECT CAST(s_suppkey AS VARCHAR) AS station_id,
        CAST(21 + s_nationkey AS INT) AS capacity FROM supplier""",
    "lake_volume_report": """
        SELECT 'bronze' AS layer, 'bronze_gtfs_static_stops' AS table_name, count(*) AS num_rows,
          'filled' AS state FROM supplier
        UNION ALL SELECT 'silver', 'silver_transit_supply', 0, 'empty'
        UNION ALL SELECT 'gold', 'gold_transit_capacity', NULL, 'missing'""",
    "volume_by_date": f"""SELECT {_day('feed_ts')} AS axis, count(*) AS num_rows
        FROM delays_s GROUP BY 1""",
    "volume_by_station": """SELECT station_id AS axis, count(*) AS num_rows FROM bikes_s
        GROUP BY 1""",
    "volume_by_hour": """SELECT hour_of_day AS axis, count(*) AS num_rows FROM mentions_s
        GROUP BY 1""",
    "numeric_profile": """SELECT count(*) AS num_rows,
        count(DISTINCT (service_date, hour_of_day)) AS num_distinct,
        round(min(avg_delay_seconds), 6) AS min_value,
        round(max(avg_delay_seconds), 6) AS max_value,
        round(avg(avg_delay_seconds), 6) AS avg_value FROM reliability""",
    "category_examples": """SELECT p_brand, count(*) AS num_rows,
        array_to_string(list_slice(list_sort(list(DISTINCT p_name)), 1, 5), ',') AS examples
        FROM part GROUP BY p_brand""",
    "duplicate_keys": """SELECT CAST(l_orderkey AS VARCHAR) AS trip_id,
        CAST(l_suppkey AS VARCHAR) AS stop_id, CAST(l_linenumber AS VARCHAR) AS stop_sequence,
        count(*) AS num_rows FROM lineitem GROUP BY 1, 2, 3 HAVING count(*) > 1""",
    "hourly_metric": """SELECT hour_of_day,
        round(avg(avg_delay_seconds), 6) AS mean_avg_delay_seconds
        FROM reliability GROUP BY hour_of_day""",
    "hour_range": "SELECT * FROM capacity WHERE scheduled_hour BETWEEN 8 AND 17",
    "date_range": f"""SELECT {DELAYS} FROM delays_s WHERE h3_index IS NOT NULL
        AND CAST(feed_ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'""",
    "inspected_table": f"""SELECT {DELAYS} FROM delays_s WHERE h3_index IS NOT NULL
        AND CAST(feed_ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'""",
    "table_summary": """SELECT count(*) AS num_rows, count(DISTINCT h3_index) AS num_cells
        FROM mentions_s""",
    "top_delays": f"""SELECT {RELIABILITY} FROM (SELECT * FROM reliability
        ORDER BY avg_delay_seconds DESC, route_id, service_date, hour_of_day LIMIT 10)""",
    "serving_rows": """SELECT trip_id, stop_sequence, stop_id, h3_index,
        (SELECT count(*) FROM supply) > 20000 AS truncated FROM supply
        ORDER BY trip_id, stop_sequence, stop_id LIMIT 20000""",
    "filtered_preview": f"""SELECT {SERVICES} FROM station_lines
        WHERE num_scheduled_stops > 5 AND transport_mode <> 'bus'
        ORDER BY num_scheduled_stops DESC, station_id, transport_mode, route_name NULLS FIRST
        LIMIT 10""",
}
_RUN = {
    "bronze.bronze_gtfs_tripupdates": "SELECT 1 FROM events",
    "bronze.bronze_nextbike_status": "SELECT 1 FROM events",
    "bronze.bronze_nextbike_station_information": "SELECT 1 FROM supplier",
    "bronze.bronze_viz_disruptions": "SELECT 1 FROM orders",
    "bronze.bronze_csd_mentions": "SELECT 1 FROM events",
    "bronze.bronze_gtfs_static_stops": "SELECT 1 FROM supplier",
    "bronze.bronze_gtfs_static_stop_times": "SELECT 1 FROM lineitem",
    "bronze.bronze_gtfs_static_trips": "SELECT 1 FROM orders SEMI JOIN lineitem ON l_orderkey = o_orderkey",
    "bronze.bronze_gtfs_static_routes": """SELECT 1 FROM nation WHERE n_nationkey IN (
      SELECT o_custkey % 30 FROM orders SEMI JOIN lineitem ON l_orderkey = o_orderkey)""",
    "bronze.bronze_gtfs_static_calendar": f"SELECT DISTINCT {SERVICE} FROM orders SEMI JOIN lineitem ON l_orderkey = o_orderkey",
    "bronze.bronze_gtfs_static_calendar_dates": f"""SELECT 1 FROM exceptions WHERE service_id IN (
      SELECT {SERVICE} FROM orders SEMI JOIN lineitem ON l_orderkey = o_orderkey)""",
    "silver.silver_bike_availability": SELECTS["silver_bikes"],
    "silver.silver_transit_delays": SELECTS["silver_delays"],
    "silver.silver_disruptions": SELECTS["silver_disruptions"],
    "silver.silver_transit_supply": SELECTS["silver_supply"],
    "silver.silver_csd_mentions": SELECTS["silver_mentions"],
    "gold.gold_mobility_pressure": SELECTS["mobility_pressure"],
    "gold.gold_line_reliability": SELECTS["line_reliability"],
    "gold.gold_disruptions_by_cell": SELECTS["disruptions_by_cell"],
    "gold.gold_station_services": SELECTS["station_services"],
    "gold.gold_transit_capacity": SELECTS["transit_capacity"],
    "gold.gold_csd_activity": SELECTS["csd_activity"],
    "gold.gold_mobility_vs_activity": SELECTS["mobility_vs_activity"],
    "gold.gold_delay_predictions": SELECTS["delay_predictions"],
}
SELECTS["landed_to_gold"] = " UNION ALL ".join(
    f"SELECT '{name.split('.')[0]}' AS layer, '{name.split('.')[1]}' AS table_name, count(*) AS num_rows FROM ({rows}) HAVING count(*) > 0"
    for name, rows in _RUN.items()
)
SELECTS["lake_jobs"] = SELECTS["mobility_vs_activity"]

ORACLES = {name: _with(select) for name, select in SELECTS.items()}

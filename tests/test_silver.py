import datetime as dt
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from frames import rows
from plazaflow.operators import silver
from plazaflow.operators.calendar import active_services
from plazaflow.operators.dedup import keep_first

STOPS = "stop_id string, stop_name string, parent_station string, stop_lat string, stop_lon string"


def status(spark, *stations):
    return spark.createDataFrame(
        [(s["station_id"], json.dumps(s)) for s in stations], "station_id string, payload_json string"
    )


def reading(station="A", bikes=3, ts=1000, **more):
    return {"station_id": station, "num_bikes_available": bikes, "num_docks_available": 7,
            "is_renting": 1, "is_returning": 1, "last_reported": ts, **more}


INFO = {"station_id": "A", "lat": "52.5", "lon": "13.4", "capacity": 10}


def test_readings_get_their_station(spark, event):
    out = silver.bike_availability(status(spark, reading()), status(spark, INFO), event).collect()
    assert len(out) == 1
    assert (out[0].lat, out[0].lon, out[0].capacity) == (52.5, 13.4, 10)
    assert out[0].reading_ts == dt.datetime(1970, 1, 1, 0, 16, 40)
    assert out[0].h3_index is not None


def test_unknown_stations_are_dropped_and_repeated_readings_collapse(spark, event):
    bikes = status(spark, reading(), reading(), reading(ts=2000), reading("B"))
    out = silver.bike_availability(bikes, status(spark, INFO, INFO), event)
    assert out.count() == 2


def test_the_latest_station_information_wins(spark, event):
    info = spark.createDataFrame(
        [
            ("A", json.dumps({**INFO, "capacity": 99}), dt.datetime(2026, 1, 1)),
            ("A", json.dumps({**INFO, "capacity": 12}), dt.datetime(2026, 1, 2)),
        ],
        "station_id string, payload_json string, ingest_ts timestamp",
    )
    out = silver.bike_availability(status(spark, reading()), info, event).collect()
    assert [r.capacity for r in out] == [12]


def test_numeric_coordinates_and_bad_payloads(spark, event):
    info = status(spark, {**INFO, "lat": 52.5}, {"station_id": "B", "lat": "north", "lon": "13"})
    out = silver.bike_availability(
        status(spark, reading(), reading("B"), reading("A", bikes="many", ts=5)), info, event
    )
    assert rows(out, "station_id", "num_bikes_available", "lat") == [
        ("A", 3, 52.5), ("A", None, 52.5), ("B", 3, None),
    ]


def updates(spark, *trips):
    return spark.createDataFrame(
        [(json.dumps(t), "1784000000") for t in trips], "payload_json string, feed_timestamp string"
    )


def trip(*stops, trip_id="t", route="r"):
    return {"trip": {"trip_id": trip_id, "route_id": route}, "stop_time_update": list(stops)}


def stops(spark):
    return spark.createDataFrame([("s1", "One", "", "52.5", "13.4")], STOPS)


@pytest.mark.parametrize(
    "stop, delay",
    [
        ({"stop_id": "s1", "arrival": {"delay": 120}, "departure": {"delay": 90}}, 120),
        ({"stop_id": "s1", "departure": {"delay": 90}}, 90),
        ({"stop_id": "s1", "arrival": {"delay": -45}}, -45),
    ],
)
def test_delay_of_a_stop(spark, event, stop, delay):
    out = silver.transit_delays(updates(spark, trip(stop)), stops(spark), event).collect()
    assert [(r.delay_seconds, r.h3_index is not None) for r in out] == [(delay, True)]


def test_delays_without_place_are_kept_and_stops_without_delay_dropped(spark, event):
    feed = updates(
        spark,
        trip({"stop_id": "gone", "arrival": {"delay": 5}}, {"stop_id": "s1"}),
        trip(trip_id="empty"),
        {"trip": {"trip_id": "none"}},
    )
    out = silver.transit_delays(feed.union(feed), stops(spark), event)
    assert rows(out, "stop_id", "delay_seconds", "h3_index") == [("gone", 5, None)]


def feature(properties, geometry=None):
    return json.dumps({"type": "Feature", "properties": properties, "geometry": geometry})


def test_disruption_dates_and_latest_version(spark, event):
    old = feature(
        {"tstore": "2026-08-01T00:00:00.450Z", "subtype": "old",
         "validity": {"from": "01.09.2026 08:00", "to": ""}},
        {"type": "Point", "coordinates": [13.4, 52.5]},
    )
    new = old.replace("2026-08-01", "2026-08-02").replace("old", "new")
    df = spark.createDataFrame(
        [("d", old), ("d", new), ("d", old)], "disruption_id string, payload_json string"
    )
    out = silver.disruptions(df, event).collect()
    assert len(out) == 1
    assert out[0].subtype == "new"
    assert out[0].published_ts == dt.datetime(2026, 8, 2, 0, 0, 0, 450000)
    assert out[0].valid_from == dt.datetime(2026, 9, 1, 8)
    assert out[0].valid_to is None
    assert out[0].h3_index is not None


def test_of_disruptions_published_at_one_time_the_typed_values_decide(spark, event):
    """A later day outranks an earlier one whose text is larger, and a point a line without one."""

    def of(until, geometry):
        return feature({"tstore": "2026-08-01T00:00:00Z", "validity": {"from": "", "to": until}}, geometry)

    line = {"type": "LineString", "coordinates": [[13.4, 52.5], [13.5, 52.5]]}
    point = {"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [13.4, 52.5]}]}
    df = spark.createDataFrame(
        [("day", of("30.07.2026 00:00", point)), ("day", of("01.08.2026 00:00", point)),
         ("place", of("01.08.2026 00:00", line)), ("place", of("01.08.2026 00:00", point))],
        "disruption_id string, payload_json string",
    )
    found = {r.disruption_id: r for r in silver.disruptions(df, event).collect()}
    assert found["day"].valid_to == dt.datetime(2026, 8, 1)
    assert found["place"].lat == 52.5 and found["place"].h3_index is not None


def test_a_disruption_without_geometry_or_with_broken_json_has_no_cell(spark, event):
    df = spark.createDataFrame(
        [("a", feature({})), ("b", "{broken")], "disruption_id string, payload_json string"
    )
    assert rows(silver.disruptions(df, event), "disruption_id", "h3_index") == [
        ("a", None), ("b", None),
    ]


CALENDAR = "service_id string, monday string, start_date string, end_date string"
DATES = "service_id string, date string, exception_type string"


def test_weekly_pattern(spark, event):
    calendar = spark.createDataFrame(
        [
            ("runs", "1", "20260101", "20261231"),
            ("other_day", "0", "20260101", "20261231"),
            ("expired", "1", "20250101", "20251231"),
            ("first_day", "1", "20260914", "20261231"),
            ("last_day", "1", "20260101", "20260914"),
        ],
        CALENDAR,
    )
    active = active_services(calendar, spark.createDataFrame([], DATES), event)
    assert rows(active) == [("first_day",), ("last_day",), ("runs",)]


@settings(max_examples=8, deadline=None)
@given(
    st.lists(st.tuples(st.integers(0, 5), st.booleans()), max_size=8),
    st.lists(
        st.tuples(
            st.integers(0, 7), st.sampled_from(["20260914", "20260915"]), st.sampled_from("12")
        ),
        max_size=12,
    ),
)
def test_active_services_as_sets(spark, event, weekly, exceptions):
    calendar = spark.createDataFrame(
        [(str(s), "1" if runs else "0", "20260101", "20261231") for s, runs in weekly], CALENDAR
    )
    dates = spark.createDataFrame([(str(s), d, k) for s, d, k in exceptions], DATES)
    today = [(s, k) for s, d, k in exceptions if d == "20260914"]
    expected = {s for s, runs in weekly if runs} | {s for s, k in today if k == "1"}
    expected -= {s for s, k in today if k == "2"}
    assert rows(active_services(calendar, dates, event)) == sorted((str(s),) for s in expected)


PASSES = (
    "trip_id string, stop_id string, stop_sequence string, arrival_time string,"
    " departure_time string"
)


def supply(spark, event, passes, routes=(("r", "U2", "400"),), active=("on",), parent="P"):
    return silver.transit_supply(
        spark.createDataFrame(passes, PASSES),
        spark.createDataFrame([("t", "r", "on"), ("t2", "r", "off")],
                              "trip_id string, route_id string, service_id string"),
        spark.createDataFrame(list(routes),
                              "route_id string, route_short_name string, route_type string"),
        spark.createDataFrame([("s1", "One", parent, "52.5", "13.4")] * 2, STOPS),
        spark.createDataFrame([(a,) for a in active], "service_id string"),
        event,
    )


def test_supply_of_the_event_day(spark, event):
    out = supply(
        spark,
        event,
        [
            ("t", "s1", "1", "25:10:00", ""),
            ("t", "s1", "1", "25:10:00", ""),
            ("t", "s1", "2", "", "08:00:00"),
            ("t", "s1", "3", None, None),
            ("t", "unknown", "4", "09:00:00", ""),
            ("t2", "s1", "1", "09:00:00", ""),
        ],
    )
    assert rows(out, "stop_sequence", "scheduled_hour", "station_id", "transport_mode") == [
        (1, 1, "P", "ubahn"), (2, 8, "P", "ubahn"),
    ]
    assert set(out.columns) == {
        "stop_id", "route_id", "service_id", "trip_id", "stop_sequence", "hora_programada",
        "scheduled_hour", "route_name", "route_type", "stop_name", "station_id", "lat", "lon",
        "transport_mode", "source", "h3_index",
    }


def test_a_missing_route_keeps_the_pass(spark, event):
    out = supply(spark, event, [("t", "s1", "1", "09:00:00", "")], routes=(), parent="")
    assert rows(out, "transport_mode", "route_name", "station_id") == [("otro", None, "s1")]


MENTIONS = (
    "mention_id string, event_ts string, lat double, lon double, platform string, language string,"
    " sentiment double, has_media boolean, user_hash string, source string"
)


def mention(i, ts="2026-09-14T14:03:00", lat=52.5, lon=13.4, user="u"):
    return (i, ts, lat, lon, "x", "de", 0.5, True, user, "synthetic")


def test_mentions(spark, event):
    df = spark.createDataFrame(
        [mention("a"), mention("a"), mention("b", lat=None), mention("c", ts="later")], MENTIONS
    )
    out = silver.mentions(df, event)
    assert [(r[0], r[1], r[2] is not None) for r in rows(out, "mention_id", "hour_of_day", "h3_index")] == [
        ("a", 14, True), ("b", 14, False), ("c", None, True),
    ]


def test_keep_first_against_brute_force(spark):
    data = [(i % 7, (i * 37) % 11, (i * 53) % 5, str(i % 3)) for i in range(300)]
    df = spark.createDataFrame(data, "k int, a int, b int, c string")
    expected = {}
    for row in data:
        rank = (row[1], -row[2], row[3])
        if row[0] not in expected or rank > expected[row[0]][0]:
            expected[row[0]] = (rank, row)
    wanted = sorted((r for _, r in expected.values()), key=repr)
    for join_side in (False, True):
        out = keep_first(df, ["k"], largest=["a"], smallest=["b"], join_side=join_side)
        assert rows(out) == wanted


def test_each_payload_is_parsed_once(spark, event):
    from plazaflow.plans.queries import QUERIES

    plan = QUERIES["silver_bikes"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan()
    initial = plan.toString().split("== Initial Plan ==")[-1]
    assert initial.count("from_json") == 2

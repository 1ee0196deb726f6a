import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plazaflow.config import EventConfig
from plazaflow.functions.transit import (
    event_clock,
    on_time,
    scheduled_hour,
    scheduled_time,
    station_of,
    transport_mode,
)


def apply(spark, values, make, schema="v string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r.out for r in df.select("i", make(F.col("v")).alias("out")).orderBy("i").collect()]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(0, 47), min_size=1, max_size=30))
def test_hours_past_midnight_wrap(spark, hours):
    texts = [f"{h:02d}:10:00" for h in hours]
    assert apply(spark, texts, scheduled_hour) == [h % 24 for h in hours]


def test_unreadable_hours_are_null(spark):
    assert apply(spark, ["", "noon", None, "7:05:00"], scheduled_hour) == [None, None, None, 7]


def test_modes(spark):
    types = ["700", "109", "900", "100", "106", "400", "1501", "", None]
    assert apply(spark, types, transport_mode) == [
        "bus", "sbahn", "tram", "regio", "regio", "ubahn", "otro", "otro", "otro",
    ]


def test_blank_values_fall_back(spark):
    df = spark.createDataFrame(
        [("", "b"), (None, "b"), ("a", "b"), ("", "")], "first string, second string"
    )
    times = df.select(scheduled_time(F.col("first"), F.col("second")).alias("t")).collect()
    assert [r.t for r in times] == ["b", "b", "a", None]
    stations = df.select(station_of(F.col("first"), F.col("second")).alias("s")).collect()
    assert [r.s for r in stations] == ["b", "b", "a", ""]


def test_on_time_threshold_is_inclusive(spark):
    make = lambda c: on_time(c, EventConfig())
    assert apply(spark, [-45, 60, 61], make, "v int") == [1.0, 1.0, 0.0]


@pytest.mark.parametrize(
    "zone, expected",
    [("Europe/Berlin", 14), ("UTC", 12), (None, 12), ("America/New_York", 8)],
)
def test_hours_are_read_on_the_event_clock(spark, zone, expected):
    noon_utc = int(dt.datetime(2026, 9, 14, 12, tzinfo=dt.timezone.utc).timestamp())
    df = spark.createDataFrame([(noon_utc,)], "s bigint")
    clock = event_clock(F.timestamp_seconds("s"), EventConfig(time_zone=zone))
    assert df.select(F.hour(clock).alias("h")).head()["h"] == expected


def test_the_doubled_hour_of_autumn_keeps_both_instants(spark):
    first = int(dt.datetime(2026, 10, 25, 0, 30, tzinfo=dt.timezone.utc).timestamp())
    df = spark.createDataFrame([(first,), (first + 3600,)], "s bigint")
    clock = event_clock(F.timestamp_seconds("s"), EventConfig())
    assert [r.h for r in df.select(F.hour(clock).alias("h")).collect()] == [2, 2]

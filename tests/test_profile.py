import datetime as dt

import pytest

from frames import rows
from plazaflow.operators import inventory, profile
from plazaflow.sources.contracts import BY_NAME, CATALOGUE


@pytest.fixture(scope="module")
def table(spark):
    data = [
        ("a", 8, "2026-09-14T08:00:00", 1.0),
        ("a", 9, "2026-09-14T09:00:00", 3.0),
        ("b", 9, "2026-09-15T09:00:00", 5.0),
        (None, 9, "2026-09-16T09:00:00", 7.0),
    ]
    return spark.createDataFrame(data, "h3_index string, hour_of_day int, ts string, v double")


def test_volumes(table):
    assert [tuple(r) for r in profile.volume_by_date(table, "ts").collect()] == [
        (dt.date(2026, 9, 14), 2), (dt.date(2026, 9, 15), 1), (dt.date(2026, 9, 16), 1),
    ]
    assert profile.volume_by_station(table, "h3_index").head()["axis"] == "a"
    assert rows(profile.volume_by_hour(table, "hour_of_day")) == [(8, 1), (9, 3)]


def test_examples_are_few_sorted_and_distinct(spark):
    data = [("bus", str(i % 8)) for i in range(80)] + [("tram", None), (None, "x")]
    df = spark.createDataFrame(data, "mode string, name string")
    out = profile.category_examples(df, "mode", "name", 5)
    assert rows(out) == [
        ("bus", 80, ["0", "1", "2", "3", "4"]), ("tram", 1, []), (None, 1, ["x"]),
    ]


def test_duplicates(table):
    assert rows(profile.duplicate_keys(table, ["h3_index"])) == [("a", 2)]


def test_hours(table):
    assert rows(profile.hourly_mean(table, "v")) == [(8, 1.0), (9, 5.0)]
    assert profile.hour_range(table, 9, 23).count() == 3
    assert profile.hour_range(table.drop("hour_of_day"), 9, 23).count() == 4
    assert profile.hour_column(table.withColumnRenamed("hour_of_day", "scheduled_hour")) == "scheduled_hour"
    with pytest.raises(ValueError):
        profile.hourly_mean(table, "hour_of_day")


def test_summary(table):
    assert rows(profile.table_summary(table)) == [(4, 2)]
    assert rows(profile.table_summary(table.drop("h3_index"))) == [(4, None)]
    assert rows(profile.numeric_profile(table, "v", ["h3_index"])) == [(4, 2, 1.0, 7.0, 4.0)]


def test_date_range_drops_rows_without_cell(table):
    first = dt.date(2026, 9, 14)
    assert profile.date_range(table, "ts", first).count() == 2
    assert profile.date_range(table, "ts", first, dt.date(2026, 9, 16)).count() == 3
    assert profile.date_range(table, None, first).count() == 3


def test_top_and_first_rows(table):
    assert [r.v for r in profile.top_rows(table, "v", 2).collect()] == [7.0, 5.0]
    some = profile.serving_rows(table, ["v"], 3).collect()
    assert [(r.v, r.truncated) for r in some] == [(1.0, True), (3.0, True), (5.0, True)]
    assert {r.truncated for r in profile.serving_rows(table, ["v"], 100).collect()} == {False}


def test_inventory(spark, lake):
    assert inventory.inventory(lake).count() == 0
    lake.append_bronze(spark.range(3).toDF("mention_id"), "bronze_csd_mentions", "synthetic")
    lake.append_bronze(spark.range(3).toDF("mention_id"), "bronze_csd_mentions", "synthetic")
    lake.replace(spark.range(0).toDF("route_id"), "gold", "gold_line_reliability")
    out = inventory.inventory(lake)
    assert rows(out.drop("metrics_ts")) == [
        ("bronze", "bronze_csd_mentions", 6, 4, 2), ("gold", "gold_line_reliability", 0, 1, 1),
    ]
    report = inventory.volume_report(lake)
    states = {r.table_name: r.state for r in report.collect()}
    assert len(states) == len(CATALOGUE) == 24
    assert states["bronze_csd_mentions"] == "filled"
    assert states["gold_line_reliability"] == "empty"
    assert sum(s == "missing" for s in states.values()) == 22


def test_breakdowns_and_inspection(spark, lake, table):
    silver = table.withColumnRenamed("ts", "event_ts")
    lake.replace(silver, "silver", "silver_csd_mentions")
    assert set(inventory.breakdowns(lake, "silver_csd_mentions")) == {"date", "hour"}
    assert BY_NAME["gold_station_services"].layer == "gold"
    assert inventory.inspect(lake, "silver_csd_mentions", dt.date(2026, 9, 15)).count() == 1
    assert inventory.inspect(lake, "gold_csd_activity") is None
    with pytest.raises(ValueError):
        inventory.inspect(lake, "gold_unheard_of")

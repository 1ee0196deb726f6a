"""Silver kept up by change against silver built anew."""

import datetime as dt

import pytest
from frames import rows

from plazaflow.operators import silver
from plazaflow.plans import upkeep
from plazaflow.sources.contracts import MENTIONS

TABLE = "silver_csd_mentions"


def mention(i, ts, lat=52.5):
    return (i, ts, lat, 13.4, "x", "de", 0.1, True, "u")


def land(spark, lake, *given):
    return lake.append_bronze(spark.createDataFrame(list(given), MENTIONS), "bronze_csd_mentions", "synthetic")


def anew(lake, event):
    return silver.mentions(lake.read("bronze", "bronze_csd_mentions"), event)


def days_of(lake):
    path = lake.path("silver", TABLE)
    return sorted(lake._names(f"{path}/{lake.parts('silver', TABLE)[0]}", "_day="))


def test_runs_read_new_commits_and_write_touched_days(spark, lake, event):
    land(spark, lake, mention("a", "2026-09-14 10:00:00"), mention("b", "2026-09-15 10:00:00"))
    assert upkeep.keep_up(lake, TABLE, event) == upkeep.Run("full", 2, 2)
    assert upkeep.keep_up(lake, TABLE, event) == upkeep.Run("none", 0, 0)
    land(spark, lake, mention("c", "2026-09-15 11:00:00"), mention("b", "2026-09-15 10:00:00", 52.6), mention("d", None))
    # Three rows read; of silver only the touched day and the rows without one are written.
    assert upkeep.keep_up(lake, TABLE, event) == upkeep.Run("days", 3, 3)
    assert rows(lake.read("silver", TABLE)) == rows(anew(lake, event))
    assert days_of(lake) == ["_day=2026-09-14", "_day=2026-09-15", "_day=__HIVE_DEFAULT_PARTITION__"]


def test_a_key_that_moves_leaves_its_day(spark, lake, event):
    land(spark, lake, mention("a", "2026-09-14 10:00:00"), mention("b", "2026-09-15 10:00:00"))
    upkeep.keep_up(lake, TABLE, event)
    land(spark, lake, mention("a", "2026-09-16 10:00:00"))
    assert upkeep.keep_up(lake, TABLE, event).mode == "days"
    assert rows(lake.read("silver", TABLE)) == rows(anew(lake, event))
    assert days_of(lake) == ["_day=2026-09-15", "_day=2026-09-16"]


def test_an_unnoted_run_is_repeated(spark, lake, event, monkeypatch):
    land(spark, lake, mention("a", "2026-09-14 10:00:00"))
    upkeep.keep_up(lake, TABLE, event)
    land(spark, lake, mention("b", "2026-09-14 11:00:00"))
    with monkeypatch.context() as m:
        m.setattr(upkeep, "_note", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            upkeep.keep_up(lake, TABLE, event)
    assert upkeep.keep_up(lake, TABLE, event) == upkeep.Run("days", 1, 2)
    assert rows(lake.read("silver", TABLE)) == rows(anew(lake, event))


def test_an_empty_table_is_built_until_it_has_rows(spark, lake, event):
    land(spark, lake, mention("a", "2026-09-14 10:00:00"))
    empty = lake.read("bronze", "bronze_csd_mentions").where("false")
    lake.replace(silver.mentions(empty, event), "silver", TABLE)
    assert upkeep.keep_up(lake, TABLE, event).mode == "full"
    assert lake.read("silver", TABLE).count() == 1


def test_changed_dimensions_build_anew(spark, lake, event):
    status = "station_id string, payload_json string"
    info = [("s1", '{"lat": 52.5, "lon": 13.4, "capacity": 5}')]

    def reading(ts):
        return ("s1", f'{{"num_bikes_available": 1, "last_reported": {ts}}}')

    def commit(table, given):
        lake.append_bronze(spark.createDataFrame(given, status), table, "real")

    name = "silver_bike_availability"
    commit("bronze_nextbike_station_information", info)
    commit("bronze_nextbike_status", [reading(0)])
    assert upkeep.keep_up(lake, name, event).mode == "full"
    commit("bronze_nextbike_status", [reading(90_000), reading(0)])
    assert upkeep.keep_up(lake, name, event) == upkeep.Run("days", 2, 2)
    commit("bronze_nextbike_station_information", [("s1", '{"lat": 1.0, "lon": 13.4, "capacity": 7}')])
    assert upkeep.keep_up(lake, name, event).mode == "full"
    assert {r.capacity for r in lake.read("silver", name).collect()} == {7}
    assert {r.reading_ts.date() for r in lake.read("silver", name).collect()} == {dt.date(1970, 1, 1), dt.date(1970, 1, 2)}

import pathlib
import random

import pytest
from pyspark.errors import AnalysisException

from frames import rows
from plazaflow.sources import timetable
from plazaflow.sources.contracts import TIMETABLE


def write(folder, name, text, bom=False):
    path = pathlib.Path(folder)
    path.mkdir(exist_ok=True)
    (path / f"{name}.txt").write_text(text, encoding="utf-8-sig" if bom else "utf-8")


def test_columns_are_taken_by_name(spark, tmp_path):
    write(tmp_path, "stops", 'stop_lon,other,stop_id,stop_name\n13.4,x,1,"A, B"\n,,2,\n', bom=True)
    out = timetable.read_timetable_file(spark, str(tmp_path), "stops")
    assert out.columns == TIMETABLE["stops"].fieldNames()
    assert rows(out, "stop_id", "stop_name", "stop_lon", "zone_id") == [
        ("1", "A, B", "13.4", None), ("2", None, None, None),
    ]


def test_a_byte_order_mark_does_not_hide_the_first_column(spark, tmp_path):
    write(tmp_path, "routes", "route_id,route_type\nr,700\n", bom=True)
    out = timetable.read_timetable_file(spark, str(tmp_path), "routes")
    assert rows(out, "route_id", "route_type") == [("r", "700")]


def test_parts_must_agree_on_their_columns(spark, tmp_path):
    write(tmp_path / "stops.txt", "a", "stop_id,stop_name\n1,A\n", bom=True)
    write(tmp_path / "stops.txt", "b", "stop_id,stop_name\n2,B\n", bom=True)
    read = lambda: rows(
        timetable.read_timetable_file(spark, str(tmp_path), "stops"), "stop_id", "stop_name"
    )
    assert read() == [("1", "A"), ("2", "B")]
    write(tmp_path / "stops.txt", "c", "stop_name,stop_id\nC,3\n")
    with pytest.raises(Exception, match="header|FAILED_READ_FILE"):
        read()


def test_optional_files_may_be_missing_and_others_not(spark, tmp_path):
    assert timetable.read_timetable_file(spark, str(tmp_path), "calendar").count() == 0
    with pytest.raises(AnalysisException):
        timetable.read_timetable_file(spark, str(tmp_path), "trips")


def make_timetable(folder, with_calendar=True):
    rng = random.Random(7)
    stops = [(f"s{i}", 52.3 + rng.random() * 0.4, 13.2 + rng.random() * 0.4) for i in range(60)]
    trips = [(f"r{rng.randrange(9)}", f"c{rng.randrange(6)}", f"t{i}") for i in range(40)]
    times = [(f"t{rng.randrange(45)}", f"s{rng.randrange(65)}", i) for i in range(120)]
    # One stop holds a third of the passes.
    times += [("t0", "s0", 1000 + i) for i in range(60)]
    write(folder, "stops", "stop_id,stop_lat,stop_lon\n"
          + "".join(f"{s},{a},{o}\n" for s, a, o in stops) + "blank,,\nbad,north,13.4\n")
    write(folder, "trips", "route_id,service_id,trip_id\n"
          + "".join(",".join(t) + "\n" for t in trips))
    write(folder, "stop_times", "trip_id,stop_id,stop_sequence,arrival_time\n"
          + "".join(f"{t},{s},{i},08:00:00\n" for t, s, i in times))
    write(folder, "routes", "route_id\n" + "".join(f"r{i}\n" for i in range(12)))
    if with_calendar:
        write(folder, "calendar", "service_id,monday\n" + "".join(f"c{i},1\n" for i in range(8)))
    write(folder, "calendar_dates", "service_id,date,exception_type\n"
          + "".join(f"c{i},20260914,1\n" for i in range(8)))
    return stops, trips, times


def test_the_cascade_against_brute_force(spark, lake, tmp_path, event):
    folder = tmp_path / "gtfs"
    stops, trips, times = make_timetable(folder)
    near = {s for s, a, o in stops if 52.4994 - 3 / 111.32 <= a <= 52.5163 + 3 / 111.32
            and 13.3542 - 3 / 67.7519 <= o <= 13.4022 + 3 / 67.7519}
    near_times = [t for t in times if t[1] in near]
    near_trips = [t for t in trips if t[2] in {x[0] for x in near_times}]
    expected = {
        "stops": len(near),
        "stop_times": len(near_times),
        "trips": len(near_trips),
        "routes": len({t[0] for t in near_trips}),
        "calendar": len({t[1] for t in near_trips}),
        "calendar_dates": len({t[1] for t in near_trips}),
    }
    assert 0 < expected["stops"] < 60 and 0 < expected["trips"] < 40
    lazy = timetable.cut_to_area(timetable.read_timetable(spark, str(folder)), event)
    assert {name: df.count() for name, df in lazy.items()} == expected
    assert timetable.ingest_timetable(lake, str(folder), event) == expected
    written = lake.read("bronze", "bronze_gtfs_static_trips")
    assert {r[0] for r in rows(written, "trip_id")} == {t[2] for t in near_trips}


def test_a_timetable_without_calendar(spark, lake, tmp_path, event):
    folder = tmp_path / "gtfs"
    make_timetable(folder, with_calendar=False)
    assert timetable.ingest_timetable(lake, str(folder), event)["calendar"] == 0
    assert lake.read("bronze", "bronze_gtfs_static_calendar").count() == 0


def test_an_optional_file_that_cannot_be_read_is_an_error(spark, tmp_path):
    (tmp_path / "calendar.txt").mkdir()  # unpacking was interrupted
    with pytest.raises(Exception):
        timetable.read_timetable_file(spark, str(tmp_path), "calendar").collect()
    assert timetable.read_timetable_file(spark, str(tmp_path), "calendar_dates").count() == 0

"""The jobs from landed files to the last gold table."""

import datetime as dt
import json
import pathlib

from frames import rows
from plazaflow.config import EventConfig
from plazaflow.operators.forecast import ForestSettings
from plazaflow.plans import jobs

EVENT = EventConfig(day=dt.date(2026, 9, 14))
PLACE = (52.5111, 13.4022)
T0 = int(dt.datetime(2026, 9, 14, 4, tzinfo=dt.timezone.utc).timestamp())


def write(folder, name, content):
    path = pathlib.Path(folder)
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text(content if isinstance(content, str) else json.dumps(content))


def land(lake):
    for hour in range(14):
        entity = [
            {
                "id": f"e{r}{i}",
                "trip_update": {
                    "trip": {"trip_id": f"t{r}{i}", "route_id": f"r{r}"},
                    "stop_time_update": [{"stop_id": "s1", "arrival": {"delay": 20 * r + hour}}],
                },
            }
            for r in range(6)
            for i in range(2)
        ]
        stamp = T0 + 3600 * hour
        write(lake.landing("gtfs_rt"), f"{hour}.json",
              {"header": {"timestamp": str(stamp)}, "entity": entity})
        write(lake.landing("gbfs_status"), f"{hour}.json",
              {"last_updated": stamp, "data": {"stations": [
                  {"station_id": "b1", "num_bikes_available": hour, "num_docks_available": 5,
                   "is_renting": 1, "is_returning": 1, "last_reported": stamp}]}})
    write(lake.landing("gbfs_information"), "0.json", {"last_updated": 1, "data": {"stations": [
        {"station_id": "b1", "lat": PLACE[0], "lon": PLACE[1], "capacity": 9}]}})
    write(lake.landing("viz"), "0.json", {"features": [
        {"properties": {"id": "d1", "validity": {"from": "01.09.2026 08:00", "to": "30.09.2026 23:59"}},
         "geometry": {"type": "Point", "coordinates": [PLACE[1], PLACE[0]]}}]})


def timetable(folder):
    write(folder, "stops.txt", f"stop_id,stop_name,stop_lat,stop_lon\ns1,One,{PLACE[0]},{PLACE[1]}\nfar,Far,50,10\n")
    write(folder, "stop_times.txt", "trip_id,stop_id,stop_sequence,arrival_time\n"
          + "".join(f"t{h},s1,1,{h:02d}:00:00\n" for h in range(27)) + "x,far,1,08:00:00\n")
    write(folder, "trips.txt", "route_id,service_id,trip_id\n"
          + "".join(f"r0,c,t{h}\n" for h in range(27)) + "r1,c,x\n")
    write(folder, "routes.txt", "route_id,route_short_name,route_type\nr0,U2,400\nr1,M1,900\n")
    write(folder, "calendar.txt", "service_id,monday,start_date,end_date\nc,1,20260101,20261231\n")
    return str(folder)


def test_from_landed_files_to_the_forecast(spark, lake, tmp_path):
    land(lake)
    bronze = jobs.bronze_job(lake, EVENT, timetable(tmp_path / "gtfs"))
    assert bronze == {
        "gtfs_rt": 168, "gbfs_status": 14, "gbfs_information": 1, "viz": 1,
        "gtfs_static": 1 + 27 + 27 + 1 + 1 + 0,
    }
    assert jobs.stream_job(lake, EVENT, batches=2, per_batch=500) == {"landed": 1000, "ingested": 1000}
    assert jobs.silver_job(lake, EVENT) == {
        "silver_bike_availability": 14, "silver_transit_delays": 168, "silver_disruptions": 1,
        "silver_transit_supply": 27, "silver_csd_mentions": 1000,
    }
    gold = jobs.gold_job(lake, EVENT)
    assert gold["gold_mobility_pressure"] == 14
    assert gold["gold_line_reliability"] == 6 * 14
    assert gold["gold_disruptions_by_cell"] == gold["gold_station_services"] == 1
    assert gold["gold_transit_capacity"] == 24
    assert 0 < gold["gold_csd_activity"] == gold["gold_mobility_vs_activity"]

    # 04:00 UTC is 06:00 on the event's clock.
    hours = rows(lake.read("gold", "gold_mobility_pressure"), "hour_of_day")
    assert sorted(h for (h,) in hours) == list(range(6, 20))
    met = lake.read("gold", "gold_mobility_vs_activity").where(
        "num_bike_readings is not null and num_scheduled_stops is not null"
    )
    assert met.count() > 0

    published = jobs.forecast_job(lake, ForestSettings(trees=5, depth=4))
    assert published == {"gold_delay_predictions": 6}
    assert jobs.inventory_job(lake)["gold_pipeline_metrics"] == 24
    metrics = lake.read("gold", "gold_pipeline_metrics")
    assert metrics.where("num_delta_versions = 0").count() == 0


def test_command_line(spark, lake, capsys):
    jobs.main([lake.root, "stream", "--day", "2026-09-21"])
    assert capsys.readouterr().out.strip() == "{'landed': 2000, 'ingested': 2000}"
    jobs.main([lake.root, "inventory"])
    metrics = lake.read("gold", "gold_pipeline_metrics")
    assert rows(metrics, "table_name", "num_rows") == [("bronze_csd_mentions", 2000)]
    days = lake.read("bronze", "bronze_csd_mentions").where("event_ts like '2026-09-21T%'")
    assert days.count() == 2000


def test_a_failing_table_does_not_stop_the_others(spark, lake):
    jobs.stream_job(lake, EVENT, batches=1, per_batch=50)
    done = jobs.silver_job(lake, EVENT)
    assert done.pop("silver_csd_mentions") == 50
    assert set(done.values()) == {jobs.FAILED}
    bronze = jobs.bronze_job(lake, EVENT)
    assert set(bronze.values()) == {jobs.FAILED}

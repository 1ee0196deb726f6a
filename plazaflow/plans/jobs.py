"""The jobs: landed feeds to bronze, stream, silver, gold, forecast.

    python -m plazaflow.plans.jobs ROOT bronze|stream|silver|gold|forecast|inventory|all

Within a stage one failing table does not stop the others; it is reported as -1.
"""

from __future__ import annotations

import argparse
import datetime as dt
import logging
from collections.abc import Callable, Mapping

from pyspark import StorageLevel

from plazaflow.config import EventConfig, build_session
from plazaflow.operators import forecast, gold, inventory, silver
from plazaflow.operators.calendar import active_services
from plazaflow.operators.features import training_features
from plazaflow.sources.feeds import FEEDS, ingest_feed
from plazaflow.sources.lake import Lake
from plazaflow.sources.mentions import land_mentions
from plazaflow.sources.timetable import ingest_timetable
from plazaflow.streaming.mentions import ingest_mentions

log = logging.getLogger(__name__)
FAILED = -1


def isolated(steps: Mapping[str, Callable[[], int]]) -> dict[str, int]:
    """Runs the steps in order; a step that raises is logged and counted as -1."""
    rows = {}
    for name, step in steps.items():
        try:
            rows[name] = step()
        except Exception:
            log.exception("step %s failed", name)
            rows[name] = FAILED
    return rows


def bronze_job(
    lake: Lake, event: EventConfig, timetable_folder: str | None = None
) -> dict[str, int]:
    """Ingests the newly landed feed documents; the timetable only when its folder is given."""
    steps = {feed: lambda feed=feed: ingest_feed(lake, feed) for feed in FEEDS}
    if timetable_folder:
        steps["gtfs_static"] = lambda: sum(
            ingest_timetable(lake, timetable_folder, event).values()
        )
    return isolated(steps)


def stream_job(
    lake: Lake, event: EventConfig, batches: int = 5, per_batch: int = 400
) -> dict[str, int]:
    """Generates mentions and ingests what is pending."""
    return {
        "landed": land_mentions(lake, event, batches, per_batch),
        "ingested": ingest_mentions(lake),
    }


def silver_job(lake: Lake, event: EventConfig) -> dict[str, int]:
    """Rebuilds the silver tables from all of bronze."""

    def events(name):
        return lake.read("bronze", name)

    def snapshot(name):
        return lake.read("bronze", f"bronze_gtfs_static_{name}")

    def supply():
        active = active_services(snapshot("calendar"), snapshot("calendar_dates"), event)
        return silver.transit_supply(
            *[snapshot(n) for n in ("stop_times", "trips", "routes", "stops")], active, event
        )

    plans = {
        "silver_bike_availability": lambda: silver.bike_availability(
            events("bronze_nextbike_status"),
            lake.read("bronze", "bronze_nextbike_station_information"),
            event,
        ),
        "silver_transit_delays": lambda: silver.transit_delays(
            events("bronze_gtfs_tripupdates"), snapshot("stops"), event
        ),
        "silver_disruptions": lambda: silver.disruptions(
            events("bronze_viz_disruptions"), event
        ),
        "silver_transit_supply": supply,
        "silver_csd_mentions": lambda: silver.mentions(events("bronze_csd_mentions"), event),
    }
    return isolated(
        {
            name: lambda name=name, plan=plan: lake.replace(plan(), "silver", name)
            for name, plan in plans.items()
        }
    )


def gold_job(lake: Lake, event: EventConfig) -> dict[str, int]:
    """Rebuilds the gold tables; the last one reads three written before it."""

    def table(name):
        return lake.read(name.split("_", 1)[0], name)

    plans = {
        "gold_mobility_pressure": lambda: gold.mobility_pressure(
            table("silver_bike_availability"), table("silver_transit_delays"), event
        ),
        "gold_line_reliability": lambda: gold.line_reliability(
            table("silver_transit_delays"), event
        ),
        "gold_disruptions_by_cell": lambda: gold.disruptions_by_cell(
            table("silver_disruptions"), event
        ),
        "gold_station_services": lambda: gold.station_services(table("silver_transit_supply")),
        "gold_transit_capacity": lambda: gold.transit_capacity(table("silver_transit_supply")),
        "gold_csd_activity": lambda: gold.event_activity(table("silver_csd_mentions"), event),
        "gold_mobility_vs_activity": lambda: gold.mobility_vs_activity(
            table("gold_csd_activity"),
            table("gold_mobility_pressure"),
            table("gold_transit_capacity"),
        ),
    }
    return isolated(
        {
            name: lambda name=name, plan=plan: lake.replace(plan(), "gold", name)
            for name, plan in plans.items()
        }
    )


def forecast_job(
    lake: Lake, settings: forecast.ForestSettings = forecast.ForestSettings()
) -> dict[str, int]:
    """Trains, saves, reloads and publishes the forecast of every line's next hour."""
    reliability = lake.read("gold", "gold_line_reliability")
    if reliability.isEmpty():
        raise RuntimeError("gold_line_reliability has no slot to forecast from")
    # Trees pass over the features many times; the rest of the job reads them again.
    features = training_features(reliability).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model, report = forecast.train(features, settings)
        forecast.save_model(lake, model, report)
    finally:
        features.unpersist()
    published = forecast.predictions(forecast.load_model(lake), reliability)
    return {"gold_delay_predictions": lake.replace(published, "gold", "gold_delay_predictions")}


def inventory_job(lake: Lake) -> dict[str, int]:
    rows = lake.replace(inventory.inventory(lake).coalesce(1), "gold", "gold_pipeline_metrics")
    return {"gold_pipeline_metrics": rows}


def run_all(
    lake: Lake,
    event: EventConfig,
    timetable_folder: str | None = None,
    batches: int = 5,
    settings: forecast.ForestSettings = forecast.ForestSettings(),
) -> dict[str, dict[str, int]]:
    """All stages in order; without `batches` only mentions that have landed are taken in."""
    return {
        "bronze": bronze_job(lake, event, timetable_folder),
        "stream": stream_job(lake, event, batches),
        "silver": silver_job(lake, event),
        "gold": gold_job(lake, event),
        "forecast": forecast_job(lake, settings),
    }


def main(argv: list[str] | None = None) -> None:
    args = argparse.ArgumentParser(prog="plazaflow")
    args.add_argument("root", help="root folder of the lake")
    args.add_argument(
        "stage", choices=["bronze", "stream", "silver", "gold", "forecast", "inventory", "all"]
    )
    args.add_argument("--day", type=dt.date.fromisoformat, help="event day, yyyy-mm-dd")
    args.add_argument("--timetable", help="folder of the unpacked timetable files")
    args.add_argument("--format", default="parquet", help="table format, parquet or delta")
    given = args.parse_args(argv)

    logging.basicConfig(level=logging.INFO)
    event = EventConfig(day=given.day) if given.day else EventConfig()
    lake = Lake(build_session(f"plazaflow-{given.stage}"), given.root, given.format)
    stages = {
        "bronze": lambda: bronze_job(lake, event, given.timetable),
        "stream": lambda: stream_job(lake, event),
        "silver": lambda: silver_job(lake, event),
        "gold": lambda: gold_job(lake, event),
        "forecast": lambda: forecast_job(lake),
        "inventory": lambda: inventory_job(lake),
        "all": lambda: run_all(lake, event, given.timetable),
    }
    print(stages[given.stage]())


if __name__ == "__main__":
    main()

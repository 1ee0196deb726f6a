"""Timetable and delay expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plazaflow.config import EventConfig

# Extended route types of the timetable and the mode each stands for.
MODE_BY_ROUTE_TYPE = {
    "700": "bus",
    "109": "sbahn",
    "900": "tram",
    "100": "regio",
    "106": "regio",
    "400": "ubahn",
}
OTHER_MODE = "otro"


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def transport_mode(route_type: Column) -> Column:
    """Mode of a route type; unknown and missing types are the catch-all mode."""
    modes = F.create_map(*[F.lit(x) for pair in MODE_BY_ROUTE_TYPE.items() for x in pair])
    return F.coalesce(F.try_element_at(modes, route_type), F.lit(OTHER_MODE))


def scheduled_time(arrival: Column, departure: Column) -> Column:
    """Arrival text, or departure where the stop gives no arrival."""
    return F.coalesce(blank_to_null(arrival), blank_to_null(departure))


def scheduled_hour(time_text: Column) -> Column:
    """Hour of the service day; timetables count past midnight (25:10 is hour 1)."""
    return F.substring_index(time_text, ":", 1).try_cast("int") % 24


def station_of(parent_station: Column, stop_id: Column) -> Column:
    """Parent station, or the stop itself when it has none."""
    return F.coalesce(blank_to_null(parent_station), stop_id)


def on_time(delay_seconds: Column, event: EventConfig) -> Column:
    """1.0 when the delay is within the threshold (early counts as on time), else 0.0."""
    return F.when(delay_seconds <= event.on_time_seconds, 1.0).otherwise(0.0)


def event_clock(instant: Column, event: EventConfig) -> Column:
    """Wall-clock time of an instant in the event's zone, whatever the session zone is."""
    if event.time_zone is None:
        return instant
    return F.convert_timezone(None, F.lit(event.time_zone), instant.cast("timestamp_ntz"))

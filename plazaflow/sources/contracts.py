"""Table contracts: lake tables, bronze columns and the JSON payloads they carry."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

LAYERS = ("bronze", "silver", "gold")


@dataclass(frozen=True)
class TableInfo:
    """A lake table and the columns a volume report may break it down by."""

    name: str
    date: str | None = None
    station: str | None = None
    hour: str | None = None

    @property
    def layer(self) -> str:
        return self.name.split("_", 1)[0]


# The lake's tables and their breakdown columns.
CATALOGUE = (
    TableInfo("bronze_gtfs_tripupdates", date="ingest_date"),
    TableInfo("bronze_gtfs_static_stops", date="ingest_date", station="stop_id"),
    TableInfo("bronze_gtfs_static_stop_times", date="ingest_date", station="stop_id"),
    TableInfo("bronze_gtfs_static_trips", date="ingest_date"),
    TableInfo("bronze_gtfs_static_routes", date="ingest_date"),
    TableInfo("bronze_gtfs_static_calendar", date="ingest_date"),
    TableInfo("bronze_gtfs_static_calendar_dates", date="ingest_date"),
    TableInfo("bronze_nextbike_status", date="ingest_date", station="station_id"),
    TableInfo("bronze_nextbike_station_information", date="ingest_date", station="station_id"),
    TableInfo("bronze_viz_disruptions", date="ingest_date"),
    TableInfo("bronze_csd_mentions", date="ingest_date"),
    TableInfo("silver_bike_availability", date="reading_ts", station="station_id"),
    TableInfo("silver_transit_delays", date="feed_ts", station="stop_id"),
    TableInfo("silver_disruptions", date="valid_from"),
    TableInfo("silver_transit_supply", station="station_id", hour="scheduled_hour"),
    TableInfo("silver_csd_mentions", date="event_ts", hour="hour_of_day"),
    TableInfo("gold_mobility_pressure", hour="hour_of_day"),
    TableInfo("gold_line_reliability", hour="hour_of_day"),
    TableInfo("gold_disruptions_by_cell"),
    TableInfo("gold_station_services", station="station_id"),
    TableInfo("gold_transit_capacity", hour="scheduled_hour"),
    TableInfo("gold_csd_activity", hour="hour_of_day"),
    TableInfo("gold_mobility_vs_activity", hour="hour_of_day"),
    TableInfo("gold_delay_predictions", hour="hour_of_day"),
)
BY_NAME = {t.name: t for t in CATALOGUE}


def _strings(names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names.split()])


# Column names of the bronze tables and of the feeds' JSON payloads.
TRIP_UPDATES = _strings("entity_id payload_json feed_timestamp source_url")
STATIONS = _strings("station_id payload_json source_url feed_last_updated")
DISRUPTIONS = _strings("disruption_id payload_json source_url")

TIMETABLE = {
    "stops": _strings(
        "stop_id stop_code stop_name stop_desc stop_lat stop_lon location_type parent_station"
        " wheelchair_boarding platform_code zone_id level_id"
    ),
    "stop_times": _strings(
        "trip_id stop_id stop_sequence pickup_type drop_off_type stop_headsign"
        " arrival_time departure_time"
    ),
    "trips": _strings(
        "route_id service_id trip_id trip_headsign trip_short_name direction_id block_id"
        " shape_id wheelchair_accessible bikes_allowed"
    ),
    "routes": _strings(
        "route_id agency_id route_short_name route_long_name route_type route_color"
        " route_text_color route_desc"
    ),
    "calendar": _strings(
        "service_id monday tuesday wednesday thursday friday saturday sunday start_date end_date"
    ),
    "calendar_dates": _strings("service_id date exception_type"),
}
OPTIONAL_TIMETABLE_FILES = ("calendar", "calendar_dates")

MENTIONS = (
    T.StructType()
    .add("mention_id", "string")
    .add("event_ts", "string")
    .add("lat", "double")
    .add("lon", "double")
    .add("platform", "string")
    .add("language", "string")
    .add("sentiment", "double")
    .add("has_media", "boolean")
    .add("user_hash", "string")
)

STATION_STATUS_JSON = (
    "station_id string, num_bikes_available int, num_docks_available int,"
    " is_renting int, is_returning int, last_reported bigint"
)
# Some operators send coordinates as text, so they are read as text and cast later.
STATION_INFO_JSON = "station_id string, lat string, lon string, capacity int"

TRIP_UPDATE_JSON = (
    "trip struct<trip_id: string, route_id: string, start_date: string>,"
    " stop_time_update array<struct<stop_id: string, stop_sequence: int,"
    " arrival: struct<delay: int>, departure: struct<delay: int>>>"
)

# Geometry coordinates are read as text: how deep they nest depends on the type.
DISRUPTION_JSON = (
    "properties struct<id: string, tstore: string, objectState: string, subtype: string,"
    " icon: string, severity: string, street: string, section: string, content: string,"
    " validity: struct<from: string, to: string>>,"
    " geometry struct<type: string, coordinates: string,"
    " geometries: array<struct<type: string, coordinates: string>>>"
)
DISRUPTION_TIME_FORMAT = "dd.MM.yyyy HH:mm"

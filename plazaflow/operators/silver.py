"""Bronze to silver: typed, de-duplicated and placed on the grid.

Cells, modes and stations are computed on the small dimension tables before the join, once per
station or route instead of once per reading or scheduled pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazaflow.config import EventConfig
from plazaflow.functions.geo import representative_point, with_cell
from plazaflow.functions.transit import (
    OTHER_MODE,
    blank_to_null,
    scheduled_hour,
    scheduled_time,
    station_of,
    transport_mode,
)
from plazaflow.operators.dedup import keep_first
from plazaflow.sources.contracts import (
    DISRUPTION_JSON,
    DISRUPTION_TIME_FORMAT,
    STATION_INFO_JSON,
    STATION_STATUS_JSON,
    TRIP_UPDATE_JSON,
)


def bike_readings(status: DataFrame) -> DataFrame:
    """station x reading_ts from station status payloads."""
    # The id is bronze's own column: what the join below asks of it must not parse payloads again.
    typed = status.select(
        blank_to_null(F.col("station_id")).alias("station_id"),
        F.from_json("payload_json", STATION_STATUS_JSON).alias("p"),
    ).select(
        "station_id",
        "p.num_bikes_available",
        "p.num_docks_available",
        "p.is_renting",
        "p.is_returning",
        F.timestamp_seconds("p.last_reported").alias("reading_ts"),
    )
    return keep_first(typed, ["station_id", "reading_ts"])


def bike_stations(info: DataFrame, event: EventConfig) -> DataFrame:
    """One row per station, from its latest information payload."""
    version = ["ingest_ts"] if "ingest_ts" in info.columns else []
    known = info.select(
        blank_to_null(F.col("station_id")).alias("station_id"), "payload_json", *version
    )
    # Ranked as text; only the payload that is kept is parsed.
    latest = keep_first(known, ["station_id"], largest=version, join_side=True)
    typed = latest.select(
        "station_id", F.from_json("payload_json", STATION_INFO_JSON).alias("p")
    ).select(
        "station_id",
        F.col("p.lat").try_cast("double").alias("lat"),
        F.col("p.lon").try_cast("double").alias("lon"),
        "p.capacity",
    )
    return with_cell(typed, event)


def bike_availability(status: DataFrame, info: DataFrame, event: EventConfig) -> DataFrame:
    """Readings with their station's place; readings of unknown stations are dropped."""
    return placed_readings(bike_readings(status), info, event)


def placed_readings(readings: DataFrame, info: DataFrame, event: EventConfig) -> DataFrame:
    return readings.join(bike_stations(info, event), "station_id")


def stop_delays(updates: DataFrame) -> DataFrame:
    """trip x stop x feed_ts: the arrival delay of a stop, or its departure delay.

    Early passes (negative delays) are kept; stops without any delay and trips without stops are
    not.
    """
    stops = updates.select(
        F.from_json("payload_json", TRIP_UPDATE_JSON).alias("p"),
        F.timestamp_seconds(F.col("feed_timestamp").try_cast("bigint")).alias("feed_ts"),
    ).select(
        "p.trip.trip_id",
        "p.trip.route_id",
        "feed_ts",
        F.explode("p.stop_time_update").alias("s"),
    )
    delays = stops.select(
        "trip_id",
        "route_id",
        F.col("s.stop_id").alias("stop_id"),
        F.coalesce("s.arrival.delay", "s.departure.delay").alias("delay_seconds"),
        "feed_ts",
    ).where(F.col("delay_seconds").isNotNull())
    return keep_first(delays, ["trip_id", "stop_id", "feed_ts"], largest=["delay_seconds"])


def stop_places(stops: DataFrame, event: EventConfig) -> DataFrame:
    """One row per stop with its station, coordinates and cell."""
    typed = stops.select(
        "stop_id",
        "stop_name",
        station_of(F.col("parent_station"), F.col("stop_id")).alias("station_id"),
        F.col("stop_lat").try_cast("double").alias("lat"),
        F.col("stop_lon").try_cast("double").alias("lon"),
    )
    return with_cell(keep_first(typed, ["stop_id"], join_side=True), event)


def transit_delays(updates: DataFrame, stops: DataFrame, event: EventConfig) -> DataFrame:
    """Delays with their stop's place; delays at unknown stops are kept without a place."""
    return placed_delays(stop_delays(updates), stops, event)


def placed_delays(delays: DataFrame, stops: DataFrame, event: EventConfig) -> DataFrame:
    places = stop_places(stops, event).select("stop_id", "lat", "lon", "h3_index")
    return delays.join(places, "stop_id", "left")


def disruptions(features: DataFrame, event: EventConfig) -> DataFrame:
    """One row per disruption, its latest published version, with a representative point.

    A feed hands most disruptions over again and again. Of versions published at one time the typed
    values decide, in the order of the columns: text would put 02.07. above 01.08., and a version
    without a point above one that has it. Each payload is parsed once; only the row kept is placed.
    """
    parsed = features.select(
        "disruption_id", F.from_json("payload_json", DISRUPTION_JSON).alias("f")
    ).select("disruption_id", "f.properties", representative_point(F.col("f.geometry")).alias("at"))
    typed = parsed.select(
        "disruption_id",
        "properties.subtype",
        "properties.severity",
        "properties.street",
        "properties.section",
        "properties.content",
        F.col("properties.objectState").alias("object_state"),
        F.col("properties.tstore").try_cast("timestamp").alias("published_ts"),
        F.try_to_timestamp("properties.validity.from", F.lit(DISRUPTION_TIME_FORMAT)).alias(
            "valid_from"
        ),
        F.try_to_timestamp("properties.validity.to", F.lit(DISRUPTION_TIME_FORMAT)).alias(
            "valid_to"
        ),
        "at.lon",
        "at.lat",
    )
    return with_cell(keep_first(typed, ["disruption_id"], largest=["published_ts"]), event)


def scheduled_passes(stop_times: DataFrame) -> DataFrame:
    """trip x stop x stop_sequence with its scheduled time; passes without an hour are dropped."""
    timed = stop_times.select(
        "trip_id",
        "stop_id",
        F.col("stop_sequence").try_cast("int").alias("stop_sequence"),
        scheduled_time(F.col("arrival_time"), F.col("departure_time")).alias("hora_programada"),
    ).withColumn("scheduled_hour", scheduled_hour(F.col("hora_programada")))
    return keep_first(
        timed.where(F.col("scheduled_hour").isNotNull()),
        ["trip_id", "stop_id", "stop_sequence"],
        smallest=["hora_programada"],
    )


def running_trips(trips: DataFrame, routes: DataFrame, active: DataFrame) -> DataFrame:
    """Trips of active services with the name and mode of their line."""
    lines = routes.select(
        "route_id",
        F.col("route_short_name").alias("route_name"),
        "route_type",
        transport_mode(F.col("route_type")).alias("transport_mode"),
    )
    return (
        trips.select("trip_id", "route_id", "service_id")
        .join(active, "service_id", "left_semi")
        .join(lines, "route_id", "left")
        .fillna({"transport_mode": OTHER_MODE})
    )


def transit_supply(
    stop_times: DataFrame,
    trips: DataFrame,
    routes: DataFrame,
    stops: DataFrame,
    active: DataFrame,
    event: EventConfig,
) -> DataFrame:
    """Scheduled passes of the event day: one row per trip, stop and position on the trip.

    Passes are cut to the running trips before they are ranked. Beyond the broadcast size both
    meet by a shuffle on the trip, which the rank within a trip and the join after it use again.
    """
    running = running_trips(trips, routes, active)
    passes = stop_times.join(running.select("trip_id"), "trip_id", "left_semi")
    return (
        scheduled_passes(passes)
        .join(running, "trip_id")
        .join(stop_places(stops, event), "stop_id")
        .withColumn("source", F.lit("real"))
    )


def mention_rows(landed: DataFrame) -> DataFrame:
    """One row per mention.

    `event_ts` is text of the event's own wall clock, parsed and read back in the session zone,
    so the hour is the hour written in the text.
    """
    typed = landed.select(
        "mention_id",
        F.try_to_timestamp("event_ts").alias("event_ts"),
        "lat",
        "lon",
        "platform",
        "language",
        "sentiment",
        "has_media",
        "user_hash",
        "source",
    )
    return keep_first(typed, ["mention_id"])


def placed_mentions(rows: DataFrame, event: EventConfig) -> DataFrame:
    return with_cell(rows.withColumn("hour_of_day", F.hour("event_ts")), event)


def mentions(landed: DataFrame, event: EventConfig) -> DataFrame:
    """One row per mention with its hour and cell."""
    return placed_mentions(mention_rows(landed), event)

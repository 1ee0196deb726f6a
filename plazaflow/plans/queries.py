"""Every operator as a query over the provided tables.

Each query takes (spark, folder of the parquet tables) and returns a DataFrame. Results are given
in types two engines print alike: doubles with six decimals, times and lists as text.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plazaflow.config import EventConfig, scratch_dir
from plazaflow.functions import icosahedron
from plazaflow.functions.draws import pseudonym
from plazaflow.functions.geo import hex_cell, representative_point, with_cell, with_cell_center
from plazaflow.operators import features as feat
from plazaflow.operators import forecast, gold, inventory, profile, silver
from plazaflow.operators.calendar import active_services
from plazaflow.plans import jobs, upkeep
from plazaflow.plans import testdata as data
from plazaflow.sources import feeds, timetable
from plazaflow.sources.contracts import BY_NAME, DISRUPTION_JSON, MENTIONS
from plazaflow.sources.lake import RELEASED, Lake, configured, with_provenance
from plazaflow.sources.mentions import mentions_for
from plazaflow.streaming.mentions import (
    REASON,
    REJECTED,
    TABLE,
    ingest_checked_mentions,
    ingest_mentions,
)

# A day the order dates cover.
DAY = dt.date(1998, 6, 15)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return portable(build(spark, folder))

    QUERIES[build.__name__] = run
    return build


def portable(df: DataFrame) -> DataFrame:
    def shown(field: T.StructField):
        c = F.col(field.name)
        if isinstance(field.dataType, T.DoubleType):
            c = F.round(c, 6)
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.ArrayType):
            c = F.array_join(c, ",")
        return c.alias(field.name)

    return df.select(*[shown(f) for f in df.schema.fields])


def event_of(spark: SparkSession, **changes) -> EventConfig:
    """The tables' times have no zone, so the event's clock is the session's."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    return EventConfig(day=DAY, time_zone=zone, **changes)


def scratch_lake(spark: SparkSession, purpose: str) -> Lake:
    return Lake(spark, scratch_dir(spark, purpose))


# -- silver and gold inputs shared by the queries --------------------------------------------------


def _bikes(spark, folder):
    return silver.bike_availability(
        data.replayed(data.station_status(spark, folder)),
        data.station_information(spark, folder),
        event_of(spark),
    )


def _delays(spark, folder):
    return silver.transit_delays(
        data.replayed(data.trip_updates(spark, folder)),
        data.replayed(data.stops(spark, folder)),
        event_of(spark),
    )


def _disruptions(spark, folder):
    return silver.disruptions(data.replayed(data.features(spark, folder)), event_of(spark))


def _active(spark, folder):
    event = event_of(spark)
    return active_services(
        data.calendar(spark, folder, event), data.calendar_dates(spark, folder, event), event
    )


def _supply(spark, folder):
    return silver.transit_supply(
        data.stop_times(spark, folder),
        data.trips(spark, folder),
        data.routes(spark, folder),
        data.replayed(data.stops(spark, folder)),
        _active(spark, folder),
        event_of(spark),
    )


def _mentions(spark, folder):
    return silver.mentions(data.replayed(data.mentions(spark, folder)), event_of(spark))


def _reliability(spark, folder):
    return gold.line_reliability(_delays(spark, folder), event_of(spark))


# -- sources and sinks -----------------------------------------------------------------------------


@query
def provenance_tags(spark, folder):
    tagged = with_provenance(data.mentions(spark, folder).drop("source"), "synthetic")
    return tagged.groupBy("source", "platform").agg(
        F.count("*").alias("num_rows"),
        F.count_if(F.to_date("ingest_ts") == F.col("ingest_date")).alias("num_stamped"),
    )


@query
def bronze_append(spark, folder):
    """Two appends, one of each provenance, read back by partition."""
    lake = scratch_lake(spark, "append")
    rows = data.station_status(spark, folder)
    lake.append_bronze(rows, "bronze_nextbike_status", "real")
    lake.append_bronze(rows, "bronze_nextbike_status", "synthetic")
    back = lake.read("bronze", "bronze_nextbike_status", since=dt.date(2020, 1, 1))
    return back.groupBy("station_id", "source").agg(F.count("*").alias("num_rows"))


@query
def bronze_snapshot(spark, folder):
    """A second snapshot with another schema replaces the first."""
    lake = scratch_lake(spark, "snapshot")
    rows = data.stops(spark, folder)
    lake.replace_bronze(rows, "bronze_gtfs_static_stops", "real")
    lake.replace_bronze(
        rows.withColumn("platform_code", F.lit("P")), "bronze_gtfs_static_stops", "real"
    )
    return lake.read("bronze", "bronze_gtfs_static_stops").select(
        "stop_id", "stop_name", "platform_code", "source"
    )


@query
def feed_envelope_explode(spark, folder):
    return feeds.station_rows(data.station_documents(spark, folder)).select(
        "station_id",
        "source_url",
        "feed_last_updated",
        F.get_json_object("payload_json", "$.num_bikes_available").cast("int").alias("num_bikes"),
    )


@query
def trip_update_entities(spark, folder):
    return feeds.trip_update_rows(data.realtime_documents(spark, folder)).select(
        "entity_id",
        "feed_timestamp",
        "source_url",
        F.get_json_object("payload_json", "$.trip.trip_id").alias("trip_id"),
    )


@query
def feed_url_lookup(spark, folder):
    return feeds.feed_urls(data.discovery_documents(spark, folder), "station_status")


@query
def geojson_points(spark, folder):
    rows = feeds.disruption_rows(data.feature_documents(spark, folder))
    parsed = rows.select(
        "disruption_id", "source_url", F.from_json("payload_json", DISRUPTION_JSON).alias("f")
    )
    point = representative_point(F.col("f.geometry"))
    return parsed.select(
        "disruption_id", "source_url", point["lon"].alias("lon"), point["lat"].alias("lat")
    )


@query
def timetable_file_scan(spark, folder):
    """Stops written as text with their columns in another order, read back by name."""
    out = scratch_dir(spark, "timetable")
    stops = data.stops(spark, folder)
    stops.select(*reversed(stops.columns)).write.option("header", True).csv(f"{out}/stops.txt")
    return timetable.read_timetable_file(spark, out, "stops").select(
        "stop_id", "stop_name", "parent_station", "zone_id"
    )


@query
def pseudonymised_users(spark, folder):
    users = data.load(spark, folder, "events").groupBy("user_id").agg(
        F.count("*").alias("num_events")
    )
    return users.select(pseudonym(F.col("user_id"), data.SALT).alias("user_hash"), "num_events")


@query
def generated_mentions(spark, folder):
    """One generated mention per event."""
    ids = data.load(spark, folder, "events").select(F.col("event_id").alias("number"))
    return mentions_for(ids, event_of(spark))


@query
def stream_ingest(spark, folder):
    """Mentions landed and drained in two halves; a third run finds nothing new."""
    lake = scratch_lake(spark, "stream")
    mentions = data.mentions(spark, folder).select(*MENTIONS.fieldNames())
    half = F.crc32("mention_id") % 2
    for i in (0, 1):
        mentions.where(half == i).write.mode("append").json(lake.landing("mentions"))
        ingest_mentions(lake)
    ingest_mentions(lake)
    return lake.read("bronze", "bronze_csd_mentions").select(*MENTIONS.fieldNames(), "source")


@query
def stream_replays_and_rejects(spark, folder):
    """Mentions landed twice, with broken, truncated and id-less lines among them; rows of both tables."""
    lake = scratch_lake(spark, "checked")
    mentions = data.mentions(spark, folder).select(*MENTIONS.fieldNames())
    line = F.to_json(F.struct(*MENTIONS.fieldNames()))
    part = F.substring("mention_id", 5, 12).cast("bigint") % 5
    lines = mentions.select(
        F.when(part == 1, F.substring(line, 1, 30))  # truncated
        .when(part == 2, F.regexp_replace(line, '"mention_id":"[^"]*",', ""))
        .when(part == 3, F.regexp_replace(line, '"lat":', '"lat":"far ') )  # broken from here on
        .when(part == 4, F.regexp_replace(line, '"lat":[^,]*', '"lat":"far"'))
        .otherwise(line)
        .alias("value")
    )
    whole = mentions.select(line.alias("value"))
    # Then most of it again, as another producer's files, and last all lines as they should be.
    for name, rows in (("first", lines), ("again", lines.where("value not like '%far%'")), ("whole", whole)):
        rows.write.text(f"{lake.landing('mentions')}/{name}")
        ingest_checked_mentions(lake)
    back = lake.read("bronze", TABLE).groupBy(F.lit("kept").alias("kind")).agg(
        F.count("*").alias("num_rows"), F.count_distinct("mention_id").alias("num_ids"), F.count("lat").alias("num_lat")
    )
    none = F.lit(0).cast("bigint")
    aside = lake.read("bronze", REJECTED).groupBy(F.col(REASON).alias("kind")).agg(F.count("*").alias("num_rows"))
    return back.unionByName(aside.select("kind", "num_rows", none.alias("num_ids"), none.alias("num_lat")))


@query
def sql_distinct_services(spark, folder):
    """SQL over a registered view: an aggregate over a DISTINCT sub-query."""
    data.calendar(spark, folder, event_of(spark)).createOrReplaceTempView("calendar")
    return spark.sql(
        "SELECT count(*) AS num_services, min(start_date) AS first_day, max(end_date) AS last_day"
        " FROM (SELECT DISTINCT service_id, start_date, end_date FROM calendar)"
    )


@query
def silver_kept_up(spark, folder):
    """Two ingests, the second with replays and late rows; silver after it against one built from all of bronze."""
    lake, event = scratch_lake(spark, "upkeep"), event_of(spark)
    facts = {
        "silver_bike_availability": ("bronze_nextbike_status", data.station_status(spark, folder), "payload_json"),
        "silver_transit_delays": ("bronze_gtfs_tripupdates", data.trip_updates(spark, folder), "payload_json"),
        "silver_csd_mentions": ("bronze_csd_mentions", data.mentions(spark, folder).select(*MENTIONS.fieldNames()), "mention_id"),
    }
    info = data.station_information(spark, folder)
    lake.append_bronze(info.drop("ingest_ts"), "bronze_nextbike_station_information", "real")
    lake.replace_bronze(data.stops(spark, folder), "bronze_gtfs_static_stops", "real")
    runs = {}
    for parts in ((0, 1), (1, 2)):
        for table, rows, key in facts.values():
            lake.append_bronze(rows.where((F.crc32(key) % 3).isin(*parts)), table, "real")
        runs = {table: upkeep.keep_up(lake, table, event) for table in facts}
    found = None
    for table, run in runs.items():
        how = upkeep.KEPT[table]
        dims = [lake.read("bronze", name) for name in how.dimensions]
        anew = how.placed(how.rows(lake.read("bronze", how.facts)), dims, event)
        kept = lake.read("silver", table).select(*anew.columns)
        odd = kept.exceptAll(anew).unionByName(anew.exceptAll(kept)).agg(F.count("*").alias("num_differences"))
        new = lake.read_commits(how.facts, lake.parts("bronze", how.facts)).count()
        row = odd.select(F.lit(table).alias("table_name"), F.lit(run.mode).alias("mode"), "num_differences",
                         F.lit(run.rows_read < new).alias("read_less_than_all"))
        found = row if found is None else found.unionByName(row)
    return found


# -- timetable cascade -----------------------------------------------------------------------------


def _timetable(spark, folder):
    event = event_of(spark)
    return {
        "stops": data.wide_stops(spark, folder),
        "stop_times": data.stop_times(spark, folder),
        "trips": data.trips(spark, folder),
        "routes": data.routes(spark, folder),
        "calendar": data.calendar(spark, folder, event),
        "calendar_dates": data.calendar_dates(spark, folder, event),
    }


def _cascade(spark, folder):
    return timetable.cut_to_area(_timetable(spark, folder), event_of(spark))


@query
def bbox_stops(spark, folder):
    return timetable.stops_in_area(data.wide_stops(spark, folder), event_of(spark)).select(
        "stop_id",
        F.col("stop_lat").cast("double").alias("lat"),
        F.col("stop_lon").cast("double").alias("lon"),
    )


@query
def filtered_passes(spark, folder):
    """Passes at the stops in the area by way of a filter of the stops; rows that pass the filter alone."""
    stops = timetable.stops_in_area(data.wide_stops(spark, folder), event_of(spark))
    keys, passes = stops.count(), data.stop_times(spark, folder)
    near = timetable.perhaps_in(passes, "stop_id", keys, stops)
    known = stops.select("stop_id", F.lit(1).alias("known")).distinct()
    counts = near.join(known, "stop_id", "left").agg(
        F.count("known").alias("num_rows"), F.count("*").alias("through")
    )
    return counts.select("num_rows", (F.col("through") <= 1.1 * F.col("num_rows") + 5).alias("few_too_many"))


@query
def placed_stops_scan(spark, folder):
    """Stops laid out by place, written, and read back by the box of the area."""
    path = scratch_dir(spark, "placed")
    timetable.placed_stops(data.wide_stops(spark, folder), 8).write.parquet(path)
    found = timetable.placed_in_area(spark.read.parquet(path), event_of(spark))
    return found.select("stop_id", "lat", "lon")


@query
def timetable_semijoin_cascade(spark, folder):
    """Rows each of the six tables keeps: written as timetable files and ingested step by step."""
    lake, files = scratch_lake(spark, "cascade"), scratch_dir(spark, "timetable")
    for name, df in _timetable(spark, folder).items():
        df.write.option("header", True).csv(f"{files}/{name}.txt")
    rows = timetable.ingest_timetable(lake, files, event_of(spark))
    kept = None
    for name in rows:
        written = lake.read("bronze", f"bronze_gtfs_static_{name}")
        counted = written.agg(F.lit(name).alias("table_name"), F.count("*").alias("num_rows"))
        kept = counted if kept is None else kept.union(counted)
    return kept


@query
def cascade_trips(spark, folder):
    return _cascade(spark, folder)["trips"].select("trip_id", "route_id", "service_id")


@query
def cascade_exceptions(spark, folder):
    return _cascade(spark, folder)["calendar_dates"]


# -- silver ----------------------------------------------------------------------------------------


@query
def json_payload_parse(spark, folder):
    return silver.bike_readings(data.replayed(data.station_status(spark, folder)))


@query
def trip_update_flatten(spark, folder):
    return silver.stop_delays(data.replayed(data.trip_updates(spark, folder)))


@query
def scheduled_passes(spark, folder):
    return silver.scheduled_passes(data.replayed(data.stop_times(spark, folder)))


@query
def active_service_ids(spark, folder):
    return _active(spark, folder)


@query
def active_without_exceptions(spark, folder):
    """A timetable whose file of exceptions is left out."""
    files, event = scratch_dir(spark, "timetable"), event_of(spark)
    data.calendar(spark, folder, event).write.option("header", True).csv(f"{files}/calendar.txt")
    calendar, exceptions = (timetable.read_timetable_file(spark, files, n) for n in ("calendar", "calendar_dates"))
    return active_services(calendar, exceptions, event)


@query
def running_trip_modes(spark, folder):
    return silver.running_trips(
        data.trips(spark, folder), data.routes(spark, folder), _active(spark, folder)
    )


@query
def hex_cells(spark, folder):
    return data.mentions(spark, folder).select(
        "mention_id", hex_cell(F.col("lat"), F.col("lon"), event_of(spark)).alias("h3_index")
    )


@query
def h3_cells(spark, folder):
    """Worldwide cells of the mentions: at their places, and at places spread over the globe."""
    rows = data.mentions(spark, folder).select("mention_id", "lat", "lon")
    number = F.substring("mention_id", 5, 12).cast("bigint")
    rows = rows.select(
        "*",
        (number * 7919 % 179_999 / 1000 - 90).alias("far_lat"),
        (number * 104_729 % 359_999 / 1000 - 180).alias("far_lon"),
    )
    # A file may be one split only, and cells cost more than reading does.
    rows = rows.repartition(4 * spark.sparkContext.defaultParallelism)
    rows = with_cell(rows, event_of(spark, cell_backend="h3"))
    far_lat, far_lon = F.col("far_lat"), F.col("far_lon")
    rows = icosahedron.with_cell_number(rows, "far_wide", far_lat, far_lon, 3)
    rows = icosahedron.with_cell_number(rows, "far", far_lat, far_lon, 6)
    rows = icosahedron.with_center(rows, "at", F.col("far"))
    rows = icosahedron.with_cell_number(rows, "again", F.col("at.lat"), F.col("at.lon"), 6)
    return rows.select(
        "mention_id",
        "h3_index",
        F.lower(F.hex("far_wide")).alias("far_wide"),
        F.lower(F.hex("far")).alias("far"),
        (F.col("again") == F.col("far")).alias("center_is_inside"),
    )


@query
def mentions_by_h3_cell(spark, folder):
    """Silver and gold built on worldwide cells."""
    event = event_of(spark, cell_backend="h3", h3_resolution=8)
    placed = silver.mentions(data.replayed(data.mentions(spark, folder)), event)
    return gold.mentions_by_cell_hour(placed)


@query
def cell_centers(spark, folder):
    cells = _mentions(spark, folder).select("h3_index").distinct()
    return with_cell_center(cells, event_of(spark))


@query
def silver_bikes(spark, folder):
    return _bikes(spark, folder)


@query
def silver_delays(spark, folder):
    return _delays(spark, folder)


@query
def silver_disruptions(spark, folder):
    return _disruptions(spark, folder)


@query
def silver_supply(spark, folder):
    return _supply(spark, folder)


@query
def silver_mentions(spark, folder):
    return _mentions(spark, folder)


# -- gold ------------------------------------------------------------------------------------------


@query
def mobility_pressure(spark, folder):
    return gold.mobility_pressure(_bikes(spark, folder), _delays(spark, folder), event_of(spark))


@query
def line_reliability(spark, folder):
    return _reliability(spark, folder)


@query
def disruptions_by_cell(spark, folder):
    return gold.disruptions_by_cell(_disruptions(spark, folder), event_of(spark))


@query
def disruptions_open_ended(spark, folder):
    event = event_of(spark, open_ended=True)
    return gold.disruptions_by_cell(_disruptions(spark, folder), event)


@query
def station_services(spark, folder):
    return gold.station_services(_supply(spark, folder))


@query
def transit_capacity(spark, folder):
    return gold.transit_capacity(_supply(spark, folder))


@query
def capacity_all_modes(spark, folder):
    return gold.capacity_all_modes(gold.transit_capacity(_supply(spark, folder)))


@query
def mentions_by_cell_hour(spark, folder):
    return gold.mentions_by_cell_hour(_mentions(spark, folder))


@query
def people_over_cells(spark, folder):
    """People per hour and in all, from sketches per cell and hour, against exact counts."""
    placed = _mentions(spark, folder)
    lake = scratch_lake(spark, "sketches")
    lake.replace(gold.people_sketches(placed), "gold", "people")
    sketches = lake.read("gold", "people")
    by_hour = gold.people_over(sketches, "hour_of_day")
    whole = gold.people_over(sketches).withColumn("hour_of_day", F.lit(-1))
    exact = placed.where("h3_index is not null").groupBy(F.col("hour_of_day").alias("h")).agg(
        F.count_distinct("user_hash").alias("num_users")
    )
    all_users = placed.where("h3_index is not null").agg(F.count_distinct("user_hash").alias("num_users"))
    exact = exact.unionByName(all_users.withColumn("h", F.lit(-1)))
    found = by_hour.unionByName(whole).join(exact, F.col("hour_of_day") == F.col("h"))
    off = F.abs(F.col("num_people") - F.col("num_users"))
    near = off <= 4 * gold.SKETCH_ERROR * F.col("num_users") + 1
    return found.select("hour_of_day", "num_mentions", "num_users", near.alias("estimate_is_near"))


@query
def csd_activity(spark, folder):
    return gold.event_activity(_mentions(spark, folder), event_of(spark))


@query
def activity_k_users(spark, folder):
    return gold.event_activity(_mentions(spark, folder), event_of(spark, k_on="users"))


@query
def k_anonymity_effect(spark, folder):
    activity = gold.mentions_by_cell_hour(_mentions(spark, folder))
    return gold.k_anonymity_effect(activity, event_of(spark, k_min=20))


@query
def mobility_vs_activity(spark, folder):
    event = event_of(spark)
    return gold.mobility_vs_activity(
        gold.event_activity(_mentions(spark, folder), event),
        gold.mobility_pressure(_bikes(spark, folder), _delays(spark, folder), event),
        gold.transit_capacity(_supply(spark, folder)),
    )


# -- forecast --------------------------------------------------------------------------------------


@query
def previous_slot_features(spark, folder):
    return feat.previous_slot(feat.with_slot(_reliability(spark, folder)))


@query
def training_features(spark, folder):
    return feat.in_time_order(feat.training_features(_reliability(spark, folder)))


@query
def scoring_features(spark, folder):
    return feat.scoring_features(_reliability(spark, folder))


def _features(spark, folder):
    """Training features, written because finding the cut and using it are two passes."""
    lake = scratch_lake(spark, "features")
    lake.replace(feat.training_features(_reliability(spark, folder)), "gold", "features")
    return lake.read("gold", "features")


@query
def temporal_split(spark, folder):
    features = _features(spark, folder)
    split = feat.temporal_split(features)

    def part(name, df):
        return df.agg(
            F.lit(name).alias("part"),
            F.count("*").alias("num_rows"),
            F.min("slot_ts").alias("first_slot"),
            F.max("slot_ts").alias("last_slot"),
        )

    return part("train", split.train).union(part("validation", split.validation))


@query
def persistence_baseline(spark, folder):
    split = feat.temporal_split(_features(spark, folder))
    return forecast.persistence_errors(split.validation)


def _trained(spark, folder):
    return forecast.train(_features(spark, folder))


@query
def model_metrics(spark, folder):
    """Extent of each part, errors of the baseline, and whether the forest is better than that."""
    report = _trained(spark, folder)[1]
    baseline = report.where("part = 'baseline'").select(F.col("mae_seconds").alias("_baseline"))
    of_baseline = F.col("part") == "baseline"
    return report.join(F.broadcast(baseline)).select(
        "part",
        "num_rows",
        "num_lines",
        "first_slot",
        "last_slot",
        F.when(of_baseline, F.col("mae_seconds")).alias("mae_seconds"),
        F.when(of_baseline, F.col("rmse_seconds")).alias("rmse_seconds"),
        F.when(F.col("part") == "validation", F.col("mae_seconds") < F.col("_baseline")).alias(
            "better_than_baseline"
        ),
    )


@query
def delay_predictions(spark, folder):
    """The model goes through the lake: saved with its report, loaded, applied."""
    lake = scratch_lake(spark, "model")
    features = _features(spark, folder)
    model, report = forecast.train(features)
    forecast.save_model(lake, model, report)
    trained = feat.temporal_split(features).train
    seen = trained.agg(F.min(feat.TARGET).alias("low"), F.max(feat.TARGET).alias("high")).first()
    forecasts = forecast.predictions(forecast.load_model(lake), _reliability(spark, folder))
    # Leaves are means of targets, so no forecast lies beyond them.
    within = F.col("predicted_delay_seconds").between(seen.low - 1e-6, seen.high + 1e-6)
    return forecasts.withColumn("within_targets", within).drop(
        "predicted_at", "predicted_delay_seconds"
    )


# -- inventory and jobs ----------------------------------------------------------------------------


@query
def lake_inventory(spark, folder):
    """Two commits of one table, one of another, the rest of the catalogue missing."""
    lake = scratch_lake(spark, "inventory")
    mentions = data.mentions(spark, folder).drop("source")
    lake.append_bronze(mentions, "bronze_csd_mentions", "synthetic")
    lake.append_bronze(mentions, "bronze_csd_mentions", "synthetic")
    lake.replace(_mentions(spark, folder), "silver", "silver_csd_mentions")
    return inventory.inventory(lake).drop("metrics_ts")


@query
def lake_volume_report(spark, folder):
    lake = scratch_lake(spark, "volume")
    lake.replace_bronze(data.stops(spark, folder), "bronze_gtfs_static_stops", "real")
    lake.replace(_supply(spark, folder).where(F.lit(False)), "silver", "silver_transit_supply")
    wanted = ("bronze_gtfs_static_stops", "silver_transit_supply", "gold_transit_capacity")
    return inventory.volume_report(lake, [BY_NAME[n] for n in wanted])


@query
def lake_breakdowns(spark, folder):
    """The volume breakdowns that the catalogue lists for the mentions."""
    lake = scratch_lake(spark, "breakdowns")
    lake.replace(_mentions(spark, folder), "silver", "silver_csd_mentions")
    made = None
    for kind, df in inventory.breakdowns(lake, "silver_csd_mentions").items():
        axis = F.col("axis").cast("string").alias("axis")
        part = df.select(F.lit(kind).alias("kind"), axis, "num_rows")
        made = part if made is None else made.union(part)
    return made


@query
def lake_station_versions(spark, folder):
    """Stations whose newer version, committed later, has to win; their capacity tells."""
    lake = scratch_lake(spark, "versions")
    versions = data.station_information(spark, folder)
    for version in ("ingest_ts <= timestamp_seconds(0)", "ingest_ts > timestamp_seconds(0)"):
        rows = versions.where(version).drop("ingest_ts")
        lake.append_bronze(rows, "bronze_nextbike_station_information", "real")
    info = lake.read("bronze", "bronze_nextbike_station_information")
    return silver.bike_stations(info, event_of(spark)).select("station_id", "capacity")


@query
def lake_jobs(spark, folder):
    """Bronze tables written, then the silver and gold jobs, then the last table they build.

    The large tables are written by all cores: a bronze table of one file would be read again by one task."""
    lake, event = scratch_lake(spark, "jobs"), event_of(spark)
    lake.append_bronze(data.station_status(spark, folder, spread=True), "bronze_nextbike_status", "real")
    # The older version of every station first, so that the later commit must win.
    versions = data.station_information(spark, folder)
    for version in ("ingest_ts <= timestamp_seconds(0)", "ingest_ts > timestamp_seconds(0)"):
        lake.append_bronze(
            versions.where(version).drop("ingest_ts"),
            "bronze_nextbike_station_information",
            "real",
        )
    lake.append_bronze(data.trip_updates(spark, folder, spread=True), "bronze_gtfs_tripupdates", "real")
    lake.append_bronze(data.features(spark, folder, spread=True), "bronze_viz_disruptions", "real")
    lake.append_bronze(
        data.mentions(spark, folder, spread=True).drop("source"), "bronze_csd_mentions", "synthetic"
    )
    for name, df in {
        "stops": data.stops(spark, folder),
        "stop_times": data.stop_times(spark, folder, spread=True),
        "trips": data.trips(spark, folder, spread=True),
        "routes": data.routes(spark, folder),
        "calendar": data.calendar(spark, folder, event),
        "calendar_dates": data.calendar_dates(spark, folder, event),
    }.items():
        lake.replace_bronze(df, f"bronze_gtfs_static_{name}", "real")
    jobs.silver_job(lake, event)
    jobs.gold_job(lake, event)
    return lake.read("gold", "gold_mobility_vs_activity")


# Landed files are compressed, as JSON and CSV texts take many times the room of the tables they come from. One task
# reads such a file whole, so it ends after this many rows.
LANDED = {"compression": "gzip", "maxRecordsPerFile": 1_000_000}


def _landed(documents: DataFrame, path: str, **options) -> None:
    """Every document, in files that are sequences of them."""
    texts = documents.select(F.col("document").alias("value")).write.mode("append")
    texts.options(**options).text(path, lineSep=feeds.BETWEEN)


@query
def landed_to_gold(spark, folder):
    """Documents and timetable files landed, all stages run over them; rows by table."""
    lake, files = scratch_lake(spark, "landed"), scratch_dir(spark, "timetable")
    event = event_of(spark)
    with configured(spark, RELEASED):
        _landed(data.update_documents(spark, folder), lake.landing("gtfs_rt"), **LANDED)
        _landed(data.station_documents(spark, folder), lake.landing("gbfs_status"), **LANDED)
        _landed(data.information_documents(spark, folder), lake.landing("gbfs_information"), **LANDED)
        _landed(data.feature_documents(spark, folder), lake.landing("viz"), **LANDED)
        mentions = data.mentions(spark, folder).select(*MENTIONS.fieldNames())
        mentions.write.options(**LANDED).json(lake.landing("mentions"))
        for name, df in (_timetable(spark, folder) | {"stops": data.stops(spark, folder)}).items():
            df.write.options(**LANDED).option("header", True).csv(f"{files}/{name}.txt")
    few = forecast.ForestSettings(trees=5, depth=4)
    runs = jobs.run_all(lake, event, files, batches=0, settings=few)
    failed = [t for stage in runs.values() for t, n in stage.items() if n == jobs.FAILED]
    if failed:
        raise RuntimeError(f"failed: {failed}")
    jobs.inventory_job(lake)
    found = lake.read("gold", "gold_pipeline_metrics").where("num_rows > 0")
    return found.select("layer", "table_name", "num_rows")


# -- profiling and serving -------------------------------------------------------------------------


@query
def volume_by_date(spark, folder):
    return profile.volume_by_date(_delays(spark, folder), "feed_ts")


@query
def volume_by_station(spark, folder):
    return profile.volume_by_station(_bikes(spark, folder), "station_id")


@query
def volume_by_hour(spark, folder):
    return profile.volume_by_hour(_mentions(spark, folder), "hour_of_day")


@query
def numeric_profile(spark, folder):
    return profile.numeric_profile(
        _reliability(spark, folder), "avg_delay_seconds", ["service_date", "hour_of_day"]
    )


@query
def category_examples(spark, folder):
    return profile.category_examples(data.load(spark, folder, "part"), "p_brand", "p_name")


@query
def duplicate_keys(spark, folder):
    return profile.duplicate_keys(
        data.stop_times(spark, folder), ["trip_id", "stop_id", "stop_sequence"]
    )


@query
def hourly_metric(spark, folder):
    return profile.hourly_mean(_reliability(spark, folder), "avg_delay_seconds")


@query
def hour_range(spark, folder):
    return profile.hour_range(gold.transit_capacity(_supply(spark, folder)), 8, 17)


@query
def date_range(spark, folder):
    first, last = dt.date(2024, 1, 10), dt.date(2024, 1, 12)
    return profile.date_range(_delays(spark, folder), "feed_ts", first, last)


@query
def inspected_table(spark, folder):
    """A named table of the lake, kept up by day, inspected between two days."""
    lake, event = scratch_lake(spark, "inspected"), event_of(spark)
    lake.append_bronze(data.trip_updates(spark, folder), "bronze_gtfs_tripupdates", "real")
    lake.replace_bronze(data.stops(spark, folder), "bronze_gtfs_static_stops", "real")
    upkeep.keep_up(lake, "silver_transit_delays", event)
    first, last = dt.date(2024, 1, 10), dt.date(2024, 1, 12)
    return inventory.inspect(lake, "silver_transit_delays", first, last)


@query
def table_summary(spark, folder):
    return profile.table_summary(_mentions(spark, folder))


@query
def top_delays(spark, folder):
    return profile.top_rows(
        _reliability(spark, folder),
        "avg_delay_seconds",
        10,
        ["route_id", "service_date", "hour_of_day"],
    )


@query
def serving_rows(spark, folder):
    """The viewer's first 20,000 scheduled passes."""
    return profile.serving_rows(
        _supply(spark, folder), ["trip_id", "stop_sequence", "stop_id"], 20_000
    ).select("trip_id", "stop_sequence", "stop_id", "h3_index", "truncated")


@query
def filtered_preview(spark, folder):
    """Ten busiest services outside the bus network, in SQL over a registered view."""
    gold.station_services(_supply(spark, folder)).createOrReplaceTempView("services")
    return spark.sql(
        "SELECT * FROM services WHERE num_scheduled_stops > 5 AND transport_mode <> 'bus'"
        " ORDER BY num_scheduled_stops DESC, station_id, transport_mode, route_name LIMIT 10"
    )

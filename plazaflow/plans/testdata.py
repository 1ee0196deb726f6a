"""The provided tables in the shape of the bronze contracts.

The tables hold no mobility data, so keys and measures are derived by arithmetic that a second
engine can repeat. Every table is used whole. `replayed` hands each row over twice, as a feed that
was ingested twice would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plazaflow.config import EventConfig
from plazaflow.functions.draws import padded, pseudonym

SALT = "event-mentions"


# Schemas of the provided tables; naming them saves a job that reads footers per scan.
SCHEMAS = {
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,"
        " props string"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
        " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
        " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
        " p_retailprice double"
    ),
}


def load(spark: SparkSession, folder: str, table: str, spread: bool = False) -> DataFrame:
    """A table; `spread` over all cores, for a file that is one split but whose rows cost more than reading."""
    rows = spark.read.schema(SCHEMAS[table]).parquet(f"{folder}/{table}.parquet")
    return rows.repartition(4 * spark.sparkContext.defaultParallelism) if spread else rows


def replayed(df: DataFrame) -> DataFrame:
    return df.withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("_copy")


def _lat(key: Column) -> Column:
    return F.lit(52.50) + (key * 7919 % 1000) / F.lit(100000.0)


def _lon(key: Column) -> Column:
    return F.lit(13.36) + (key * 104729 % 1000) / F.lit(100000.0)


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def mentions(spark: SparkSession, folder: str, spread: bool = False) -> DataFrame:
    """events as landed mentions."""
    key = F.col("event_id")
    return load(spark, folder, "events", spread).select(
        F.concat(F.lit("men_"), padded(key, 6)).alias("mention_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("event_ts"),
        _lat(key).alias("lat"),
        _lon(key).alias("lon"),
        F.col("event_type").alias("platform"),
        F.when(key % 3 == 0, "de").when(key % 3 == 1, "en").otherwise("pl").alias("language"),
        # Sixty-fourths are exact in binary, so means do not depend on the order of addition.
        (_k() / F.lit(64.0) - F.lit(1.0)).alias("sentiment"),
        (key % 5 < 2).alias("has_media"),
        pseudonym(F.col("user_id"), SALT).alias("user_hash"),
        F.lit("synthetic").alias("source"),
    )


def _feed_seconds() -> Column:
    return F.unix_timestamp(F.date_trunc("hour", F.col("ts").cast("timestamp")))


def _trip_update() -> Column:
    """A trip update with an arrival, a departure-only and a delay-free stop; sign-ups have none."""
    delay = F.floor("value").cast("int") - 60

    def stop(stop_id: Column, sequence: int, arrival: Column | None, departure: Column | None):
        none = F.lit(None).cast("int")
        return F.struct(
            _text(stop_id).alias("stop_id"),
            F.lit(sequence).alias("stop_sequence"),
            F.struct((none if arrival is None else arrival).alias("delay")).alias("arrival"),
            F.struct((none if departure is None else departure).alias("delay")).alias("departure"),
        )

    user = F.col("user_id")
    stops = F.array(
        stop(user, 1, delay, delay + 5),
        stop(user + 37, 2, None, delay + 15),
        stop(user + 74, 3, None, None),
    )
    return F.struct(
        F.struct(
            _text(F.col("event_id") % 97).alias("trip_id"),
            _text(user % 25).alias("route_id"),
            F.date_format("ts", "yyyyMMdd").alias("start_date"),
        ).alias("trip"),
        F.when(F.col("event_type") == "signup", F.slice(stops, 1, 0))
        .otherwise(stops)
        .alias("stop_time_update"),
    )


def trip_updates(spark: SparkSession, folder: str, spread: bool = False) -> DataFrame:
    """events as real-time trip updates: 97 trips, 25 lines, hourly feeds."""
    return load(spark, folder, "events", spread).select(
        F.concat(F.lit("e"), _text("event_id")).alias("entity_id"),
        F.to_json(_trip_update()).alias("payload_json"),
        _text(_feed_seconds()).alias("feed_timestamp"),
        F.lit("memory").alias("source_url"),
    )


def _station_status() -> Column:
    return F.struct(
        _text("user_id").alias("station_id"),
        _k().alias("num_bikes_available"),
        (100 - _k()).alias("num_docks_available"),
        F.lit(1).alias("is_renting"),
        (F.col("event_id") % 2).alias("is_returning"),
        _feed_seconds().alias("last_reported"),
    )


def station_status(spark: SparkSession, folder: str, spread: bool = False) -> DataFrame:
    """events as bike-station readings per station and hour."""
    return load(spark, folder, "events", spread).select(
        _text("user_id").alias("station_id"),
        F.to_json(_station_status()).alias("payload_json"),
        F.lit("memory").alias("source_url"),
        F.lit("0").alias("feed_last_updated"),
    )


def station_information(spark: SparkSession, folder: str) -> DataFrame:
    """supplier as bike stations, in two versions of which the later has the larger capacity."""
    key = F.col("s_suppkey")
    versions = load(spark, folder, "supplier").withColumn(
        "version", F.explode(F.array(F.lit(0), F.lit(1)))
    )
    payload = F.struct(
        _text(key).alias("station_id"),
        _text(_lat(key)).alias("lat"),
        _text(_lon(key)).alias("lon"),
        (20 + F.col("s_nationkey") + F.col("version")).alias("capacity"),
    )
    return versions.select(
        _text(key).alias("station_id"),
        F.to_json(payload).alias("payload_json"),
        F.lit("memory").alias("source_url"),
        F.lit("0").alias("feed_last_updated"),
        F.timestamp_seconds(F.col("version") * 3600).alias("ingest_ts"),
    )


def stops(spark: SparkSession, folder: str) -> DataFrame:
    """supplier as timetable stops; stations are shared by stops of one odd nation key."""
    key = F.col("s_suppkey")
    return load(spark, folder, "supplier").select(
        _text(key).alias("stop_id"),
        F.col("s_name").alias("stop_name"),
        _text(_lat(key)).alias("stop_lat"),
        _text(_lon(key)).alias("stop_lon"),
        F.when(F.col("s_nationkey") % 2 == 0, F.lit(""))
        .otherwise(F.concat(F.lit("S"), _text("s_nationkey")))
        .alias("parent_station"),
    )


def wide_stops(spark: SparkSession, folder: str) -> DataFrame:
    """The same stops spread over the whole city; every 41st has no latitude."""
    key = F.col("s_suppkey")
    lat = F.lit(52.40) + (key * 7919 % 1000) / F.lit(4000.0)
    lon = F.lit(13.30) + (key * 104729 % 1000) / F.lit(4000.0)
    return load(spark, folder, "supplier").select(
        _text(key).alias("stop_id"),
        F.col("s_name").alias("stop_name"),
        F.when(key % 41 == 0, F.lit("")).otherwise(_text(lat)).alias("stop_lat"),
        _text(lon).alias("stop_lon"),
        F.lit("").alias("parent_station"),
    )


def stop_times(spark: SparkSession, folder: str, spread: bool = False) -> DataFrame:
    """lineitem as scheduled passes; hours reach 29, some arrivals and some whole times missing."""
    hour = (F.col("l_partkey") + F.col("l_linenumber")) % 30
    time = F.concat(padded(hour, 2), F.lit(":"), padded(F.col("l_partkey") % 60, 2), F.lit(":00"))
    blank = F.lit("")
    return load(spark, folder, "lineitem", spread).select(
        _text("l_orderkey").alias("trip_id"),
        _text("l_suppkey").alias("stop_id"),
        _text("l_linenumber").alias("stop_sequence"),
        F.when(F.col("l_partkey") % 17 == 0, blank).otherwise(time).alias("arrival_time"),
        F.when(F.col("l_partkey") % 34 == 0, blank).otherwise(time).alias("departure_time"),
    )


def _service() -> Column:
    return F.concat(
        F.substring("o_orderpriority", 1, 1), F.lit("_"), _text(F.col("o_custkey") % 40)
    )


def trips(spark: SparkSession, folder: str, spread: bool = False) -> DataFrame:
    """orders as trips on 30 lines, 5 of them unknown."""
    return load(spark, folder, "orders", spread).select(
        _text("o_orderkey").alias("trip_id"),
        _text(F.col("o_custkey") % 30).alias("route_id"),
        _service().alias("service_id"),
    )


def routes(spark: SparkSession, folder: str) -> DataFrame:
    """nation as lines, with a route type per region."""
    types = F.array(*[F.lit(t) for t in ("700", "109", "900", "400", "1501")])
    return load(spark, folder, "nation").select(
        _text("n_nationkey").alias("route_id"),
        F.col("n_name").alias("route_short_name"),
        F.element_at(types, F.col("n_regionkey") + 1).alias("route_type"),
    )


def _services(spark: SparkSession, folder: str) -> DataFrame:
    """service_id, n: the services in use and the number their calendar is derived from."""
    return (
        load(spark, folder, "orders")
        .select(_service().alias("service_id"), (F.col("o_custkey") % 40).alias("n"))
        .distinct()
    )


def calendar(spark: SparkSession, folder: str, event: EventConfig) -> DataFrame:
    """Weekly pattern: a quarter does not run on the event's weekday, a fifth has expired."""
    year = event.day.year
    return _services(spark, folder).select(
        "service_id",
        F.when(F.col("n") % 4 == 0, "0").otherwise("1").alias(event.weekday),
        F.lit(f"{year}0101").alias("start_date"),
        F.when(F.col("n") % 5 == 0, f"{year}0102").otherwise(f"{year}1231").alias("end_date"),
    )


def calendar_dates(spark: SparkSession, folder: str, event: EventConfig) -> DataFrame:
    """Exceptions: some services removed, some added on the day, some on another day."""
    n = F.col("n")
    day = event.compact_day

    def exception(when: Column, date: str, kind: str) -> DataFrame:
        return services.where(when).select(
            "service_id", F.lit(date).alias("date"), F.lit(kind).alias("exception_type")
        )

    services = _services(spark, folder)
    return (
        exception(n % 7 == 0, day, "2")
        .union(exception(n % 8 == 4, day, "1"))
        .union(exception(n % 3 == 0, f"{event.day.year}0103", "2"))
    )


def _feature_json() -> Column:
    """orders as GeoJSON features in four geometry kinds; every 50th has no id."""
    key = F.col("o_orderkey")
    here = F.concat(F.lit("["), _text(_lon(key)), F.lit(","), _text(_lat(key)), F.lit("]"))
    line = F.concat(F.lit("["), here, F.lit(","), here, F.lit("]"))

    def of(kind: str, coordinates: Column) -> Column:
        return F.concat(F.lit(f'{{"type":"{kind}","coordinates":'), coordinates, F.lit("}"))

    geometry = (
        F.when(key % 4 == 0, of("Point", here))
        .when(
            key % 4 == 1,
            F.concat(
                F.lit('{"type":"GeometryCollection","geometries":['),
                of("LineString", line),
                F.lit(","),
                of("Point", here),
                F.lit("]}"),
            ),
        )
        .when(key % 4 == 2, of("LineString", line))
        .otherwise(F.lit("null"))
    )
    fmt = "dd.MM.yyyy HH:mm"
    start = F.date_format("o_orderdate", fmt)
    days = (F.col("o_custkey") % 60).cast("int")
    until = F.date_format(F.date_add(F.to_date("o_orderdate"), days), fmt)
    properties = F.to_json(
        F.struct(
            F.when(key % 50 != 0, F.concat(F.lit("D"), _text(key))).alias("id"),
            F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("tstore"),
            F.col("o_orderstatus").alias("objectState"),
            F.col("o_orderpriority").alias("subtype"),
            F.concat(F.lit("Street "), _text(F.col("o_custkey") % 100)).alias("street"),
            F.struct(
                F.when(key % 10 == 0, F.lit("")).otherwise(start).alias("from"), until.alias("to")
            ).alias("validity"),
        )
    )
    return F.concat(
        F.lit('{"type":"Feature","properties":'),
        properties,
        F.lit(',"geometry":'),
        geometry,
        F.lit("}"),
    )


def features(spark: SparkSession, folder: str, spread: bool = False) -> DataFrame:
    """orders as ingested disruption features."""
    payload = load(spark, folder, "orders", spread).select(_feature_json().alias("payload_json"))
    return payload.select(
        F.coalesce(F.get_json_object("payload_json", "$.properties.id"), F.lit("")).alias(
            "disruption_id"
        ),
        "payload_json",
        F.lit("memory").alias("source_url"),
    )


# -- feed documents: 50 consecutive keys to a document, so no document grows with the data --------

PER_DOCUMENT = 50


def _documents(df: DataFrame, key: str, element: Column, head: str, tail: str) -> DataFrame:
    number = F.floor(F.col(key) / PER_DOCUMENT)
    return (
        df.groupBy(number.alias("number"))
        .agg(F.array_join(F.collect_list(element), ",").alias("elements"))
        .select(
            F.concat(F.lit(head), "elements", F.lit(tail)).alias("document"),
            F.concat(F.lit("doc-"), _text("number")).alias("source_url"),
        )
    )


def station_documents(spark: SparkSession, folder: str) -> DataFrame:
    return _documents(
        load(spark, folder, "events"),
        "event_id",
        F.to_json(_station_status()),
        '{"last_updated":1700000000,"data":{"stations":[',
        "]}}",
    )


def information_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Station information in one document for each nation."""
    key = F.col("s_suppkey")
    station = F.struct(
        _text(key).alias("station_id"),
        _text(_lat(key)).alias("lat"),
        _text(_lon(key)).alias("lon"),
        (21 + F.col("s_nationkey")).alias("capacity"),
    )
    return _documents(
        load(spark, folder, "supplier"), "s_nationkey", F.to_json(station), '{"last_updated":"0","data":{"stations":[', "]}}"
    )


def feature_documents(spark: SparkSession, folder: str) -> DataFrame:
    return _documents(
        load(spark, folder, "orders"),
        "o_orderkey",
        _feature_json(),
        '{"type":"FeatureCollection","features":[',
        "]}",
    )


def realtime_documents(spark: SparkSession, folder: str) -> DataFrame:
    """A trip update, a vehicle or an alert per event."""
    key = F.col("event_id")
    kind = F.when(F.col("event_type") == "error", F.lit("alert")).when(
        F.col("event_type") == "view", F.lit("vehicle")
    )
    entity = F.concat(
        F.concat(F.lit('{"id":"e'), _text(key), F.lit('","')),
        F.coalesce(kind, F.lit("trip_update")),
        F.lit('":'),
        F.to_json(_trip_update()),
        F.lit("}"),
    )
    return _documents(
        load(spark, folder, "events"),
        "event_id",
        entity,
        '{"header":{"timestamp":"1700000000"},"entity":[',
        "]}",
    )


def update_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The trip updates of `trip_updates`, in documents of one feed hour each."""
    rows = trip_updates(spark, folder)
    entity = F.concat(
        F.lit('{"id":"'), "entity_id", F.lit('","trip_update":'), "payload_json", F.lit("}")
    )
    chunk = F.floor(F.substring("entity_id", 2, 20).cast("bigint") / (100 * PER_DOCUMENT))
    grouped = rows.groupBy("feed_timestamp", chunk.alias("chunk")).agg(
        F.array_join(F.collect_list(entity), ",").alias("elements")
    )
    head = F.concat(F.lit('{"header":{"timestamp":"'), "feed_timestamp", F.lit('"},"entity":['))
    return grouped.select(
        F.concat(head, "elements", F.lit("]}")).alias("document"),
        F.concat_ws("-", "feed_timestamp", "chunk").alias("source_url"),
    )


def discovery_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One discovery document per supplier; odd nation keys publish no English feeds."""
    key = _text("s_suppkey")

    def language(code: str) -> Column:
        return F.format_string(
            f'"{code}":{{"feeds":[{{"name":"system_information","url":"u/{code}/sys/%s"}},'
            f'{{"name":"station_status","url":"u/{code}/status/%s"}}]}}',
            key,
            key,
        )

    languages = F.when(
        F.col("s_nationkey") % 2 == 0, F.concat_ws(",", language("de"), language("en"))
    ).otherwise(F.concat_ws(",", language("de"), language("pl")))
    return load(spark, folder, "supplier").select(
        F.concat(F.lit('{"last_updated":1,"data":{'), languages, F.lit("}}")).alias("document"),
        F.concat(F.lit("doc-"), key).alias("source_url"),
    )

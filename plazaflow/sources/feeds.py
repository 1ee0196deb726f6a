"""Landed feed documents to bronze rows.

A document is one JSON text as the publisher served it, in a file of its own or in a sequence. Documents are parsed by Spark: the
envelope with an explicit schema, each element kept as JSON text. A document that is not JSON, or
lacks the list its feed is about, gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plazaflow.sources.contracts import DISRUPTIONS, STATIONS, TRIP_UPDATES
from plazaflow.sources.lake import Lake

STATION_ENVELOPE = "last_updated string, data struct<stations: array<string>>"
FEATURE_ENVELOPE = "features array<string>"
REALTIME_ENVELOPE = (
    "header struct<timestamp: string>, entity array<struct<id: string, trip_update: string>>"
)
# The record separator of JSON text sequences (RFC 7464).
BETWEEN = "\x1e"
DISCOVERY_ENVELOPE = "data map<string, struct<feeds: array<struct<name: string, url: string>>>>"


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """document, source_url: one row per landed document.

    A file is one document over any number of lines, or a sequence of them set apart by `BETWEEN`, which no
    JSON text holds unescaped.
    """
    return _named(spark.read.text(path, lineSep=BETWEEN))


def stream_documents(spark: SparkSession, path: str, bytes_per_batch: int = 8 << 30) -> DataFrame:
    """The same as a stream, so that each run parses only files that arrived since the last.

    Batches are bounded by their bytes: documents are small and many, and each batch is a commit.
    """
    reader = spark.readStream.format("text").schema("value string").option("lineSep", BETWEEN)
    return _named(reader.option("maxBytesPerTrigger", str(bytes_per_batch)).load(path))


def _named(files: DataFrame) -> DataFrame:
    return files.select(
        F.col("value").alias("document"), F.col("_metadata.file_path").alias("source_url")
    )


def station_rows(documents: DataFrame) -> DataFrame:
    """One bronze row per station of a bike-share status or information feed."""
    parsed = documents.select("source_url", F.from_json("document", STATION_ENVELOPE).alias("d"))
    stations = parsed.select(
        "source_url",
        F.coalesce("d.last_updated", F.lit("")).alias("feed_last_updated"),
        F.explode("d.data.stations").alias("payload_json"),
    )
    return stations.withColumn("station_id", _text_or_blank("$.station_id")).select(
        *STATIONS.fieldNames()
    )


def disruption_rows(documents: DataFrame) -> DataFrame:
    """One bronze row per feature of a GeoJSON collection; features without id share id ''."""
    features = documents.select(
        "source_url",
        F.explode(F.from_json("document", FEATURE_ENVELOPE)["features"]).alias("payload_json"),
    )
    return features.withColumn("disruption_id", _text_or_blank("$.properties.id")).select(
        *DISRUPTIONS.fieldNames()
    )


def trip_update_rows(documents: DataFrame) -> DataFrame:
    """One bronze row per entity with a trip update; vehicle and alert entities are left out."""
    parsed = documents.select("source_url", F.from_json("document", REALTIME_ENVELOPE).alias("d"))
    entities = parsed.select(
        "source_url",
        F.col("d.header.timestamp").alias("feed_timestamp"),
        F.explode("d.entity").alias("e"),
    )
    named = entities.withColumns(
        {"entity_id": F.col("e.id"), "payload_json": F.col("e.trip_update")}
    )
    return named.where(F.col("payload_json").isNotNull()).select(*TRIP_UPDATES.fieldNames())


def feed_urls(discovery: DataFrame, feed: str, language: str = "en") -> DataFrame:
    """source_url, url: where each discovery document publishes a feed.

    The wanted language is used when the document has it, otherwise its first one.
    """
    by_language = F.from_json("document", DISCOVERY_ENVELOPE)["data"]
    chosen = F.coalesce(
        F.try_element_at(by_language, F.lit(language)),
        F.try_element_at(F.map_values(by_language), F.lit(1)),
    )
    return (
        discovery.select("source_url", F.explode(chosen["feeds"]).alias("feed"))
        .where(F.col("feed.name") == feed)
        .select("source_url", F.col("feed.url").alias("url"))
    )


def find_feed_url(discovery: DataFrame, feed: str, language: str = "en") -> str:
    """URL of a feed in one discovery document; an unknown feed is an error."""
    found = feed_urls(discovery, feed, language).head()
    if found is None:
        raise ValueError(f"no feed {feed!r} in the discovery document")
    return found["url"]


def _text_or_blank(json_path: str) -> Column:
    return F.coalesce(F.get_json_object("payload_json", json_path), F.lit(""))


# Landing folder, bronze table and parser of each real-time feed.
FEEDS = {
    "gtfs_rt": ("bronze_gtfs_tripupdates", trip_update_rows),
    "gbfs_status": ("bronze_nextbike_status", station_rows),
    "gbfs_information": ("bronze_nextbike_station_information", station_rows),
    "viz": ("bronze_viz_disruptions", disruption_rows),
}


def ingest_feed(lake: Lake, feed: str) -> int:
    """Appends the documents landed since the last run to the feed's bronze table."""
    table, parse = FEEDS[feed]
    return lake.append_stream(
        parse(stream_documents(lake.spark, lake.landing(feed))), table, source="real"
    )


"""Static timetable: read the text files and keep what the event area needs.

The network timetable is large and the area small, so the reduction is a cascade of semi-joins
that starts from the stops in the area. Each step reads the table the step before has written:
the chain stays short, and a lost executor recomputes one step only.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plazaflow.config import EventConfig
from plazaflow.functions.geo import in_area, laid_out_by_place
from plazaflow.operators.dedup import distinct_join_keys
from plazaflow.sources.contracts import OPTIONAL_TIMETABLE_FILES, TIMETABLE
from plazaflow.sources.lake import Lake


def read_timetable_file(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One timetable text file as strings, its columns taken by header name.

    Columns the file lacks are null. A missing optional file is an empty table; a missing
    required one is an error, and so are parts whose columns come in different orders.
    """
    wanted = TIMETABLE[name]
    try:
        raw = spark.read.csv(f"{folder}/{name}.txt", header=True, enforceSchema=False)
    except AnalysisException as e:
        # Only a file that is not there is optional; one that cannot be read is an error.
        if name not in OPTIONAL_TIMETABLE_FILES or e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], wanted)
    present = set(raw.columns)
    return raw.select(
        *[
            F.col(c) if c in present else F.lit(None).cast("string").alias(c)
            for c in wanted.fieldNames()
        ]
    )


def read_timetable(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: read_timetable_file(spark, folder, name) for name in TIMETABLE}


def stops_in_area(stops: DataFrame, event: EventConfig) -> DataFrame:
    """Stops inside the area of interest; stops without usable coordinates are dropped."""
    lat = F.col("stop_lat").try_cast("double")
    lon = F.col("stop_lon").try_cast("double")
    return stops.where(in_area(lat, lon, event))


def placed_stops(stops: DataFrame, parts: int) -> DataFrame:
    """Stops with numeric coordinates (`lat`, `lon`), laid out for scans of an area."""
    typed = stops.withColumns(
        {"lat": F.col("stop_lat").try_cast("double"), "lon": F.col("stop_lon").try_cast("double")}
    )
    return laid_out_by_place(typed, "lat", "lon", parts)


def placed_in_area(placed: DataFrame, event: EventConfig) -> DataFrame:
    """Of a table of `placed_stops`, those in the area: only row groups that reach into it are read."""
    return placed.where(in_area(F.col("lat"), F.col("lon"), event))


# Keys from which on a filter is made of them (below, Spark broadcasts the keys themselves), and its
# largest size: 32 MB. More keys than that fits are joined without it.
FILTERED_FROM = 200_000
MAX_FILTER_BITS = 1 << 28
BITS_PER_KEY = 16
SLICE_BITS = 1 << 15
HASHES = 6  # bits of a key, all in one slice


def filter_bits(keys: int) -> int:
    return 1 << max(15, (keys * BITS_PER_KEY - 1).bit_length())


def _slice_of(key: str, keys: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(filter_bits(keys) // SLICE_BITS))


def _bit_of(key: str, which: Column) -> Column:
    """A key's bit of number `which` in its slice: steps by one odd hash from another."""
    hashed = F.xxhash64(key, F.lit(1))
    first, step = F.pmod(hashed, F.lit(SLICE_BITS)), F.shiftright(hashed, 32).bitwiseOR(F.lit(1))
    return F.pmod(first + which * F.pmod(step, F.lit(SLICE_BITS)), F.lit(SLICE_BITS)).cast("bigint")


def key_bitmap(by: DataFrame, key: str, keys: int) -> DataFrame | None:
    """A Bloom filter of the keys of `by`, in slices: `HASHES` bits for each key, of `BITS_PER_KEY` or more.

    Tasks set bits of slices of 4 KB, which are merged; a key's bits lie in one slice, so that one look-up
    finds them. Of keys that are not there fewer than one in a hundred pass. None if there are too many keys.
    """
    if filter_bits(keys) > MAX_FILTER_BITS:
        return None
    hashed = by.where(F.col(key).isNotNull()).select(
        _slice_of(key, keys).alias("slice"),
        F.explode(F.array(*[_bit_of(key, F.lit(i)) for i in range(HASHES)])).alias("bit"),
    )
    return hashed.groupBy("slice").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def unused(name: str, df: DataFrame) -> str:
    """A name like the given one that no column has."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def perhaps_in(df: DataFrame, key: str, keys: int, by: DataFrame) -> DataFrame:
    """`df` without most of the rows whose key is not in `by`; none whose key is there is left out.

    The filter is broadcast, so rows are left out where they are scanned, before any shuffle.
    """
    slices = key_bitmap(by, key, keys)
    if slices is None:
        return df
    number, bitmap = (unused(name, df) for name in ("slice", "bitmap"))
    slices = slices.select(F.col("slice").alias(number), F.col("bitmap").alias(bitmap))
    def is_set(i: int) -> Column:
        at = _bit_of(key, F.lit(i))
        byte = F.conv(F.hex(F.substring(bitmap, (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.call_function("getbit", byte, (at % 8).cast("int")) == 1

    joined = df.join(F.broadcast(slices), _slice_of(key, keys) == F.col(number))
    # One after the other: most rows of others end at the first bit.
    return joined.where(reduce(and_, [is_set(i) for i in range(HASHES)])).select(*df.columns)


def referenced(df: DataFrame, by: DataFrame, key: str, keys: int = 0) -> DataFrame:
    """Rows of `df` whose key occurs in `by`.

    The keys are made distinct first, before the shuffle on every task, so a key holding a large
    share of `by` travels once per task; a key holding a large share of `df` is split by AQE.
    Where `by` is known to have many `keys`, rows of `df` pass a filter of them before they are shuffled.
    These keys are not broadcast: packed in a file they look small, but a task's table of them grows with
    the timetable. Both sides are sorted, which spills.
    """
    wanted = distinct_join_keys(by, key)
    if keys >= FILTERED_FROM:
        df, wanted = perhaps_in(df, key, keys, by), wanted.hint("merge")
    return df.join(wanted, key, "left_semi").select(*df.columns)


def cut_to_area(tables: Mapping[str, DataFrame], event: EventConfig) -> dict[str, DataFrame]:
    """The whole cascade as one lazy plan per table."""
    stops = stops_in_area(tables["stops"], event)
    stop_times = referenced(tables["stop_times"], stops, "stop_id")
    trips = referenced(tables["trips"], stop_times, "trip_id")
    return {
        "stops": stops,
        "stop_times": stop_times,
        "trips": trips,
        "routes": referenced(tables["routes"], trips, "route_id"),
        "calendar": referenced(tables["calendar"], trips, "service_id"),
        "calendar_dates": referenced(tables["calendar_dates"], trips, "service_id"),
    }


# What each table is reduced by, in writing order.
CASCADE = (
    ("stop_times", "stops", "stop_id"),
    ("trips", "stop_times", "trip_id"),
    ("routes", "trips", "route_id"),
    ("calendar", "trips", "service_id"),
    ("calendar_dates", "trips", "service_id"),
)


def ingest_timetable(lake: Lake, folder: str, event: EventConfig) -> dict[str, int]:
    """Replaces the six timetable snapshots; returns their row counts."""
    tables = read_timetable(lake.spark, folder)

    def save(name: str, df: DataFrame) -> int:
        return lake.replace_bronze(df, f"bronze_gtfs_static_{name}", source="real")

    rows = {"stops": save("stops", stops_in_area(tables["stops"], event))}
    for name, by, key in CASCADE:
        written = lake.read("bronze", f"bronze_gtfs_static_{by}")
        rows[name] = save(name, referenced(tables[name], written, key, rows[by]))
    return rows

"""Hexagonal cells, boxes and points as column expressions (no Python in the row path)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazaflow.config import METRES_PER_DEGREE, EventConfig
from plazaflow.functions import icosahedron

SQRT3 = math.sqrt(3.0)

# How far each half of a number's bits moves so that a gap follows every bit, and the bits kept.
SPREADS = tuple(
    (width, sum(((1 << width) - 1) << k for k in range(0, 64, 2 * width))) for width in (16, 8, 4, 2, 1)
)


def hex_cell(lat: Column, lon: Column, event: EventConfig) -> Column:
    """Cell id of a point, null when a coordinate is missing or impossible.

    The point is projected to metres around the reference latitude and rounded to the nearest
    pointy-top hexagon in axial coordinates; the id is ``q_r``. The plane is faithful near the
    reference latitude, which is all a city event needs. The backend "h3" gives ids of the worldwide grid.
    """
    valid = lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0)
    if event.cell_backend == "h3":
        return F.when(valid, icosahedron.cell(lat, lon, event.h3_resolution))

    x = lon * F.lit(event.metres_per_degree_lon)
    y = lat * F.lit(METRES_PER_DEGREE)
    qf = (F.lit(SQRT3 / 3.0) * x - y / F.lit(3.0)) / F.lit(event.cell_edge_m)
    rf = (F.lit(2.0 / 3.0) * y) / F.lit(event.cell_edge_m)
    sf = -qf - rf

    def nearest(v: Column) -> Column:
        return F.floor(v + F.lit(0.5))

    q, r, s = nearest(qf), nearest(rf), nearest(sf)
    dq, dr, ds = F.abs(q - qf), F.abs(r - rf), F.abs(s - sf)
    # The rounded triple must sum to zero: recompute the axis with the largest error.
    q_off = (dq > dr) & (dq > ds)
    r_off = ~q_off & (dr > ds)
    q_id = F.when(q_off, -r - s).otherwise(q).cast("bigint")
    r_id = F.when(r_off, -q - s).otherwise(r).cast("bigint")
    return F.when(valid, F.concat_ws("_", q_id, r_id))


def cell_center(cell: Column, event: EventConfig) -> Column:
    """Centre of a cell as struct(lat, lon); null for a null or malformed id."""
    if event.cell_backend == "h3":
        return icosahedron.center(icosahedron.number_of(cell))
    parts = F.split(cell, "_")
    q = parts.getItem(0).try_cast("double")
    r = F.try_element_at(parts, F.lit(2)).try_cast("double")
    lon = F.lit(event.cell_edge_m * SQRT3) * (q + r / 2.0) / F.lit(event.metres_per_degree_lon)
    lat = F.lit(event.cell_edge_m * 1.5) * r / F.lit(METRES_PER_DEGREE)
    return F.when(q.isNotNull() & r.isNotNull(), F.struct(lat.alias("lat"), lon.alias("lon")))


def with_cell(df: DataFrame, event: EventConfig, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Adds `h3_index`, the cell of the two coordinate columns."""
    if event.cell_backend == "h3":
        la, lo = F.col(lat), F.col(lon)
        valid = la.between(-90.0, 90.0) & lo.between(-180.0, 180.0)
        places = (F.when(valid, c) for c in (la, lo))
        numbered = icosahedron.with_cell_number(df, "h3_index", *places, event.h3_resolution)
        return numbered.withColumn("h3_index", F.lower(F.hex("h3_index")))
    return df.withColumn("h3_index", hex_cell(F.col(lat), F.col(lon), event))


def with_cell_center(df: DataFrame, event: EventConfig, cell: str = "h3_index") -> DataFrame:
    """Adds `lat` and `lon` of the cell's centre, for maps."""
    if event.cell_backend == "h3":
        name = "center"
        while name in df.columns:
            name = f"_{name}"
        found = icosahedron.with_center(df, name, icosahedron.number_of(F.col(cell)))
        return found.withColumns({c: F.col(name)[c] for c in ("lat", "lon")}).drop(name)
    center = cell_center(F.col(cell), event)
    return df.withColumns({"lat": center["lat"], "lon": center["lon"]})


def area_of_interest(event: EventConfig) -> tuple[float, float, float, float]:
    """Box (lat_min, lat_max, lon_min, lon_max) around the route plus its margin."""
    lats = [p[0] for p in event.route]
    lons = [p[1] for p in event.route]
    margin_m = event.margin_km * 1000.0
    d_lat = margin_m / METRES_PER_DEGREE
    d_lon = margin_m / event.metres_per_degree_lon
    return min(lats) - d_lat, max(lats) + d_lat, min(lons) - d_lon, max(lons) + d_lon


def in_area(lat: Column, lon: Column, event: EventConfig) -> Column:
    """True inside the area of interest, edges included."""
    south, north, west, east = area_of_interest(event)
    return lat.between(south, north) & lon.between(west, east)


def morton(lat: Column, lon: Column) -> Column:
    """Place on a curve through the globe that keeps near points near: latitude and longitude in 31 bits
    each, interleaved. Null for a missing or impossible coordinate."""

    def spread(value: Column, low: float, size: float) -> Column:
        bits = F.floor((value - low) / size * (2**31 - 1)).cast("bigint")
        for shift, mask in SPREADS:
            bits = bits.bitwiseOR(F.shiftleft(bits, shift)).bitwiseAND(F.lit(mask))
        return bits

    valid = lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0)
    code = F.shiftleft(spread(lat, -90.0, 180.0), 1).bitwiseOR(spread(lon, -180.0, 360.0))
    return F.when(valid, code)


def laid_out_by_place(df: DataFrame, lat: str, lon: str, parts: int) -> DataFrame:
    """The rows in `parts` ranges of the curve, in its order.

    Written to Parquet with numeric coordinates, each file and row group then covers a small area, and
    a box on the coordinates is pushed to the scan and skips all others. Rows without a place come first.
    """
    at = morton(F.col(lat), F.col(lon))
    laid = df.withColumn("_at", at).repartitionByRange(parts, F.col("_at").asc_nulls_first())
    return laid.sortWithinPartitions(F.col("_at").asc_nulls_first()).drop("_at")


def representative_point(geometry: Column) -> Column:
    """struct(lon, lat) of a geometry: a Point, or the first Point of a collection.

    `geometry` is the parsed GeoJSON object with its coordinates still JSON text.
    """
    first_point = F.try_element_at(
        F.filter(geometry["geometries"], lambda g: g["type"] == "Point"), F.lit(1)
    )
    text = F.when(geometry["type"] == "Point", geometry["coordinates"]).when(
        geometry["type"] == "GeometryCollection", first_point["coordinates"]
    )
    # A point's coordinates are a flat list of numbers, so the text need not be parsed as JSON.
    pair = F.split(F.btrim(text, F.lit("[] ")), ",")
    return F.struct(
        F.try_element_at(pair, F.lit(1)).try_cast("double").alias("lon"),
        F.try_element_at(pair, F.lit(2)).try_cast("double").alias("lat"),
    )

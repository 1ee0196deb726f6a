import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plazaflow.config import EventConfig
from plazaflow.functions.geo import (
    area_of_interest,
    hex_cell,
    in_area,
    representative_point,
    with_cell,
    with_cell_center,
)
from plazaflow.sources.contracts import DISRUPTION_JSON

EVENT = EventConfig()


def cells(spark, points):
    df = spark.createDataFrame(
        [(i, a, o) for i, (a, o) in enumerate(points)], "i int, lat double, lon double"
    )
    return [r.h3_index for r in with_cell(df, EVENT).orderBy("i").collect()]


def test_close_points_share_a_cell_and_distant_ones_do_not(spark):
    near, moved, far = cells(spark, [(52.5163, 13.3777), (52.51645, 13.3778), (52.4994, 13.3542)])
    assert near == moved
    assert near != far


def test_missing_and_impossible_coordinates_have_no_cell(spark):
    points = [(None, 13.4), (52.5, None), (float("nan"), 13.4), (91.0, 13.4), (52.5, 181.0)]
    assert cells(spark, points) == [None] * len(points)


@settings(max_examples=5, deadline=None)
@given(
    st.lists(
        st.tuples(st.floats(52.3, 52.7), st.floats(13.0, 13.8)), min_size=20, max_size=60
    )
)
def test_a_cell_is_the_hexagon_with_the_nearest_centre(spark, points):
    df = spark.createDataFrame(points, "lat double, lon double")
    placed = with_cell(df, EVENT).select(
        "h3_index", F.col("lat").alias("plat"), F.col("lon").alias("plon")
    )

    def metres(r):
        return math.hypot(
            (r.lat - r.plat) * 111320.0, (r.lon - r.plon) * EVENT.metres_per_degree_lon
        )

    with_centres = with_cell_center(placed, EVENT).collect()
    # No point of a hexagon is farther from its centre than its corners are.
    assert all(metres(r) <= EVENT.cell_edge_m + 1e-6 for r in with_centres)
    centres = spark.createDataFrame(
        [(r.lat, r.lon, r.h3_index) for r in with_centres], "lat double, lon double, was string"
    )
    again = centres.withColumn("now", hex_cell(F.col("lat"), F.col("lon"), EVENT))
    assert again.where("now <> was").count() == 0


def test_a_malformed_cell_has_no_centre(spark):
    df = spark.createDataFrame([("x",), ("1_y",), (None,)], "h3_index string")
    assert with_cell_center(df, EVENT).where("lat is not null or lon is not null").count() == 0


def test_area_is_the_route_with_its_margin():
    south, north, west, east = area_of_interest(EVENT)
    assert south == pytest.approx(52.4994 - 3 / 111.32)
    assert north == pytest.approx(52.5163 + 3 / 111.32)
    assert 13.3542 - west == pytest.approx(east - 13.4022)
    assert 13.3542 - west > 52.4994 - south  # a degree of longitude is shorter


def test_area_includes_its_edges(spark):
    south, north, west, east = area_of_interest(EVENT)
    df = spark.createDataFrame(
        [(south, west), (north, east), (south - 1e-9, west), (None, west)], "lat double, lon double"
    )
    assert df.where(in_area(F.col("lat"), F.col("lon"), EVENT)).count() == 2


POINT = '{"type":"Point","coordinates":[13.4,52.5]}'
LINE = '{"type":"LineString","coordinates":[[1.0,2.0],[3.0,4.0]]}'


@pytest.mark.parametrize(
    "geometry, expected",
    [
        (POINT, (13.4, 52.5)),
        (f'{{"type":"GeometryCollection","geometries":[{LINE},{POINT}]}}', (13.4, 52.5)),
        (f'{{"type":"GeometryCollection","geometries":[{LINE}]}}', (None, None)),
        (LINE, (None, None)),
        ("null", (None, None)),
        ('{"type":"Point","coordinates":[13.4,52.5,34.0]}', (13.4, 52.5)),
        ('{"type":"Point","coordinates":"nowhere"}', (None, None)),
    ],
)
def test_representative_point(spark, geometry, expected):
    df = spark.createDataFrame([(f'{{"geometry":{geometry}}}',)], "j string")
    parsed = df.select(F.from_json("j", DISRUPTION_JSON)["geometry"].alias("g"))
    point = parsed.select(representative_point(F.col("g")).alias("p")).head()["p"]
    assert (point["lon"], point["lat"]) == expected

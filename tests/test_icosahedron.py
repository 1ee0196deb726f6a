"""Worldwide cells: published ids, whole coverage of the globe, centres."""

import math

import pytest
from frames import rows
from pyspark.sql import functions as F

from plazaflow.config import EventConfig
from plazaflow.functions import icosahedron as ico
from plazaflow.functions.geo import hex_cell, with_cell, with_cell_center

# Ids that the grid's public documentation gives for points.
PUBLISHED = (
    (37.775938728915946, -122.41795063018799, 9, "8928308280fffff"),
    (37.7752702151959, -122.418307270836, 9, "8928308280fffff"),
    (37.3615593, -122.0553238, 5, "85283473fffffff"),
    (37.3615593, -122.0553238, 7, "87283472bffffff"),
    (40.689167, -74.044444, 10, "8a2a1072b59ffff"),
    (37.769377, -122.388903, 9, "89283082e73ffff"),
)
# The base cells that are pentagons.
PENTAGONS = (4, 14, 24, 38, 49, 58, 63, 72, 83, 97, 107, 117)


@pytest.fixture(scope="module")
def globe(spark, tmp_path_factory):
    """Points spread evenly over the sphere, by golden angles."""
    n = 24_000
    z = 1 - (2 * F.col("id") + 1) / F.lit(n)
    turn = F.col("id") * (180 * (3 - math.sqrt(5)))
    points = spark.range(n, numPartitions=8).select(
        F.degrees(F.asin(z)).alias("lat"), (F.pmod(turn, F.lit(360.0)) - 180).alias("lon")
    )
    path = str(tmp_path_factory.mktemp("globe"))
    points.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("resolution", sorted({r for _, _, r, _ in PUBLISHED}))
def test_published_ids(spark, resolution):
    own = [(a, o, c) for a, o, r, c in PUBLISHED if r == resolution]
    df = spark.createDataFrame(own, "lat double, lon double, known string")
    found = df.select("known", ico.cell(F.col("lat"), F.col("lon"), resolution).alias("cell")).collect()
    assert all(r.known == r.cell for r in found)


def test_pentagons_and_home_faces():
    tables = ico.grid()
    assert tuple(k for k, p in enumerate(tables["pentagon"]) if p) == PENTAGONS
    assert sorted(set(tables["base"])) == list(range(-1, 122))


@pytest.mark.parametrize("resolution", [0, 1, 2, 9, 15])
def test_cells_cover_the_globe_and_hold_their_centres(globe, resolution):
    cells = globe.select("lat", "lon", ico.cell_number(F.col("lat"), F.col("lon"), resolution).alias("c"))
    cells = cells.select("*", ico.center(F.col("c")).alias("m"))
    again = ico.cell_number(F.col("m.lat"), F.col("m.lon"), resolution)
    # Chord between a point and its cell's centre, in sizes of the resolution's cells.
    a, b = (F.radians(x) for x in ("lat", "m.lat"))
    chord = F.pow(F.sin((a - b) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(F.col("lon") - F.col("m.lon")) / 2), 2)
    far = F.max(2 * F.sqrt(chord)) * math.sqrt(7) ** resolution
    row = cells.agg(F.count_distinct("c").alias("n"), F.count_if(again == F.col("c")).alias("held"), far.alias("far")).first()
    assert row.held == globe.count()
    assert row.far < 0.23
    if resolution <= 2:
        assert row.n == 2 + 120 * 7**resolution


def test_neighbouring_points_share_cells_across_faces(globe):
    """A point a metre away is in the same cell or in one whose centre is next to it."""
    near = globe.select("lat", "lon", (F.col("lon") + 1e-5).alias("lon2"))
    ids = near.select(*(ico.cell_number(F.col("lat"), F.col(c), 4).alias(c) for c in ("lon", "lon2")))
    apart = ids.where("lon <> lon2").select(ico.center(F.col("lon")).alias("a"), ico.center(F.col("lon2")).alias("b"))
    gap = F.abs(F.col("a.lat") - F.col("b.lat"))
    assert apart.agg(F.max(gap)).first()[0] < 1.0
    assert ids.where("lon <> lon2").count() < 30


@pytest.mark.parametrize("resolution", [0, 6, 9])
def test_steps_over_a_table_give_the_same(globe, resolution):
    """Cells and centres in named steps, which are compiled, without a lambda that Spark interprets."""
    known = globe.select("lat", "lon", ico.cell_number(F.col("lat"), F.col("lon"), resolution).alias("known"))
    found = ico.with_cell_number(known, "found", F.col("lat"), F.col("lon"), resolution)
    found = ico.with_center(found, "at", F.col("known"))
    far = F.abs(F.col("at.lat") - F.col("own.lat")) + F.abs(F.col("at.lon") - F.col("own.lon"))
    counts = found.withColumn("own", ico.center(F.col("known"))).agg(
        F.count_if(F.col("known") == F.col("found")).alias("same"), F.max(far).alias("far")
    )
    row = counts.first()
    assert row.same == globe.count() and row.far == 0
    plain = ico.with_center(ico.with_cell_number(globe, "n", F.col("lat"), F.col("lon"), resolution), "at", F.col("n"))
    plan = plain._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and "Python" not in plan


def test_steps_over_missing_and_impossible_values(spark):
    inf, nan = float("inf"), float("nan")
    points = [(None, 1.0, 0), (1.0, None, 0), (nan, 1.0, 0), (1.0, inf, 0), (-inf, 1.0, 0), (1.0, 1.0, 1)]
    df = spark.createDataFrame(points, "lat double, lon double, _lat int")
    found = ico.with_cell_number(df, "n", F.col("lat"), F.col("lon"), 5)
    assert found.columns == [*df.columns, "n"]
    assert [r.n is None for r in found.orderBy("_lat").collect()] == [True] * 5 + [False]
    celled = with_cell(df.withColumn("lat", F.lit(91.0)), EventConfig(cell_backend="h3"))
    assert all(r.h3_index is None for r in celled.collect())
    with pytest.raises(ValueError):
        ico.with_cell_number(df, "n", F.col("lat"), F.col("lon"), 16)


def test_missing_and_impossible_values(spark):
    df = spark.createDataFrame([(None, 1.0), (1.0, None), (float("nan"), 1.0), (91.0, 0.0)], "lat double, lon double")
    event = EventConfig(cell_backend="h3")
    assert [r[0] for r in df.select(hex_cell(F.col("lat"), F.col("lon"), event)).collect()] == [None] * 4
    ids = [("x",), (None,), ("8928308280ffff",), ("ffffffffffffffff",), ("0928308280fffff",), ("89fe308280fffff",), ("8908308280fffff",)]
    found = with_cell_center(spark.createDataFrame(ids, "h3_index string"), event).collect()
    assert all(r.lat is None and r.lon is None for r in found[:6])
    with pytest.raises(ValueError):
        ico.cell_number(F.lit(1.0), F.lit(1.0), 16)


def test_backend_of_the_event(spark):
    """The resolution is the event's, near points share a cell, and no Python runs for a row."""
    event = EventConfig(cell_backend="h3")
    df = spark.createDataFrame([(52.5163, 13.3777), (52.51645, 13.37785), (52.4994, 13.3542)], "lat double, lon double")
    celled = with_cell(df, event)
    a, b, c = (r.h3_index for r in celled.collect())
    assert a == b != c and len(a) == 15 and a[:2] == "89"
    assert "Python" not in celled._jdf.queryExecution().toString()
    back = with_cell_center(celled.select("h3_index"), event)
    assert sorted(r[2] for r in rows(with_cell(back.select("lat", "lon", F.col("h3_index").alias("was")), event))) == sorted([a, b, c])


def test_a_condition_on_the_last_value_stays_above_the_steps(spark):
    """Moved below them, it would hold every step's value in place of its name, and again in theirs."""
    steps = [lambda s: {"v0": F.col("id")}]
    steps += [lambda s, i=i: {f"v{i}": F.greatest(s[f"v{i - 1}"], 1 - s[f"v{i - 1}"])} for i in range(1, 10)]
    kept = ico._in_steps(spark.range(5), steps, "last").where("last > 2")
    assert len(kept._jdf.queryExecution().optimizedPlan().toString()) < 5000
    assert sorted(r.id for r in kept.collect()) == [3, 4]


def test_conditions_on_cells_and_centres(spark):
    event = EventConfig(cell_backend="h3", h3_resolution=8)
    df = spark.createDataFrame([(52.5, 13.4), (None, 13.4), (91.0, 0.0)], "lat double, lon double")
    kept = with_cell(df, event).where(F.col("h3_index").isNotNull())
    assert [r.lat for r in kept.collect()] == [52.5]
    assert with_cell_center(kept.select("h3_index"), event).where("lat > 0").count() == 1

"""Layouts and summaries that spare later reads: places on a curve, key filters, sketches of people."""

import glob
import random

import pyarrow.parquet as pq
import pytest
from frames import rows
from pyspark.sql import functions as F

from plazaflow.config import EventConfig
from plazaflow.functions.geo import area_of_interest, laid_out_by_place, morton
from plazaflow.operators import gold
from plazaflow.sources import timetable
from plazaflow.sources.lake import configured


def test_curve_interleaves_bits(spark):
    df = spark.createDataFrame([(-90.0, -180.0), (90.0, 180.0), (0.0, -180.0), (None, 1.0), (91.0, 0.0)], "a double, o double")
    found = [r[0] for r in df.select(morton(F.col("a"), F.col("o"))).collect()]
    assert found[0] == 0 and found[1] == 2**62 - 1 and found[3:] == [None, None]
    assert bin(found[2]).count("1") == 30  # latitude bits alone, the highest one not set


def test_a_box_reads_few_row_groups(spark, tmp_path):
    event = EventConfig(time_zone=None)
    south, north, west, east = area_of_interest(event)
    places = spark.range(60_000).select(
        "id", (F.rand(1) * 2 + 51.5).alias("lat"), (F.rand(2) * 3 + 12).alias("lon")
    )
    path = str(tmp_path / "placed")
    laid_out_by_place(places, "lat", "lon", 64).write.parquet(path)
    found = timetable.placed_in_area(spark.read.parquet(path), event)
    with configured(spark, {"spark.sql.maxMetadataStringLength": "2000"}):
        plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(lat" in plan and "LessThanOrEqual(lon" in plan
    read = total = 0
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            stats = [meta.row_group(g).column(c).statistics for c in (1, 2)]
            total += 1
            read += stats[0].max >= south and stats[0].min <= north and stats[1].max >= west and stats[1].min <= east
    assert total >= 60 and read <= total / 10
    back = spark.read.parquet(path)
    want = back.where(F.col("lat").between(south, north) & F.col("lon").between(west, east))
    assert rows(found) == rows(want) and found.count() > 0


@pytest.mark.parametrize("limit", [0, 10**9])
def test_filtered_and_plain_joins_agree(spark, monkeypatch, limit):
    monkeypatch.setattr(timetable, "FILTERED_FROM", limit)
    rnd = random.Random(2)
    times = spark.createDataFrame([(rnd.choice([None, "", *map(str, range(5000))]), i) for i in range(4000)], "k string, bitmap int")
    stops = spark.createDataFrame([(str(i),) for i in range(0, 5000, 9)] + [(None,), ("",)], "k string")
    keys = {r.k for r in stops.collect()} - {None}
    found = timetable.referenced(times, stops, "k", stops.count())
    assert rows(found) == sorted(((r.k, r.bitmap) for r in times.collect() if r.k in keys), key=repr)


def test_a_filter_lets_few_others_through(spark):
    stops = spark.range(3000).select(F.concat(F.lit("s"), F.col("id") * 50).alias("k"))
    times = spark.range(150_000).select(F.concat(F.lit("s"), "id").alias("k"))
    near = timetable.perhaps_in(times, "k", 3000, stops)
    assert 3000 <= near.count() <= 3000 + 150_000 / 10
    assert near.join(stops, "k", "left_semi").count() == 3000
    assert timetable.key_bitmap(stops, "k", 1 << 40) is None


@pytest.mark.parametrize("keys", [1140, 4000, 300_000])
def test_a_filter_of_any_load_lets_one_in_a_hundred_through(spark, keys):
    stops = spark.range(keys).select(F.col("id").cast("string").alias("k"))
    others = spark.range(10**6, 10**6 + 50_000).select(F.col("id").cast("string").alias("k"))
    assert timetable.perhaps_in(others, "k", keys, stops).count() < 500
    assert timetable.perhaps_in(stops, "k", keys, stops).count() == keys


def test_sketches_add_up(spark):
    n = 20_000
    mentions = spark.range(n).select(
        F.concat(F.lit("c"), F.col("id") % 40).alias("h3_index"),
        (F.col("id") % 24).cast("int").alias("hour_of_day"),
        F.concat(F.lit("u"), F.col("id") % 7000).alias("user_hash"),
    )
    sketches = gold.people_sketches(mentions.union(mentions.limit(1).withColumn("h3_index", F.lit(None).cast("string"))))
    (whole,) = gold.people_over(sketches).collect()
    assert whole.num_mentions == n
    assert abs(whole.num_people - 7000) <= 4 * gold.SKETCH_ERROR * 7000
    exact = mentions.groupBy("hour_of_day").agg(F.count_distinct("user_hash").alias("n"))
    for r in gold.people_over(sketches, "hour_of_day").join(exact, "hour_of_day").collect():
        assert abs(r.num_people - r.n) <= 4 * gold.SKETCH_ERROR * r.n + 1


def test_many_keys_are_sorted_not_broadcast(spark, monkeypatch):
    """Keys that look small to the planner are not held whole by a task once they are known to be many."""
    monkeypatch.setattr(timetable, "FILTERED_FROM", 100)
    times = spark.range(5000).select((F.col("id") % 900).cast("string").alias("k"), "id")
    keys = spark.range(0, 900, 3).select(F.col("id").cast("string").alias("k"))
    found = timetable.referenced(times, keys, "k", 300)
    assert found.count() == times.where("cast(k as int) % 3 = 0").count()
    plan = found._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "LeftSemi" in line]
    assert joins and all("SortMergeJoin" in line for line in joins)

"""Plans that must hold for large and unequal data."""

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from frames import rows
from plazaflow.operators import gold, profile, silver
from plazaflow.plans import testdata
from plazaflow.plans.queries import QUERIES
from plazaflow.sources import timetable

SMALL = "/root/testdata/sf0.001"


@contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def large_joins(spark):
    """No broadcasts, and partitions of kilobytes count as large."""
    return settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10k",
        # A partition is split between the tasks that wrote it; small data must keep several.
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions="16",
    )


def ran(df):
    """The plan a query ended with, and its result."""
    result = df.collect()
    return df._jdf.queryExecution().executedPlan().toString(), result


def stops(spark, n=200):
    return spark.range(n).select(
        F.col("id").cast("string").alias("stop_id"),
        F.concat(F.lit("Stop "), F.col("id")).alias("stop_name"),
        F.lit("").alias("parent_station"),
        (F.lit(52.5) + F.col("id") / 10000).cast("string").alias("stop_lat"),
        F.lit("13.4").alias("stop_lon"),
    )


def hot_stop(c):
    """A third of all rows at stop 7, the rest spread out."""
    return F.when(c % 3 == 0, F.lit(7)).otherwise(c % 200).cast("string")


def passes(spark, n=40_000):
    return spark.range(0, n, 1, 8).select(
        F.col("id").cast("string").alias("trip_id"),
        hot_stop(F.col("id")).alias("stop_id"),
        F.lit("1").alias("stop_sequence"),
        F.lit("08:00:00").alias("arrival_time"),
        F.lit("").alias("departure_time"),
    )


def test_a_stop_with_a_third_of_all_passes_is_split(spark, event):
    trips = spark.range(0, 40_000, 1, 8).select(
        F.col("id").cast("string").alias("trip_id"),
        F.lit("r").alias("route_id"),
        F.lit("c").alias("service_id"),
    )
    routes = spark.createDataFrame([("r", "U2", "400")], "route_id string, route_short_name string, route_type string")
    active = spark.createDataFrame([("c",)], "service_id string")
    with large_joins(spark):
        df = silver.transit_supply(passes(spark), trips, routes, stops(spark), active, event)
        plan, result = ran(df)
    assert "SortMergeJoin(skew=true)" in plan
    assert "BroadcastHashJoin" not in plan
    assert len(result) == 40_000


@pytest.mark.parametrize("hot", ["trip_id", "route_id", "service_id"])
def test_supply_is_whole_under_a_hot_trip_route_or_service(spark, event, hot):
    """A third of all passes on one trip, of all trips on one route, or in one service."""
    n = 12_000
    third = F.when(F.col("id") % 3 == 0, "hot")
    trip = third.otherwise(F.col("id").cast("string")) if hot == "trip_id" else F.col("id").cast("string")
    rows_ = spark.range(0, n, 1, 8)
    stop_times = rows_.select(
        trip.alias("trip_id"),
        (F.col("id") % 200).cast("string").alias("stop_id"),
        F.col("id").cast("string").alias("stop_sequence"),
        F.lit("08:00:00").alias("arrival_time"),
        F.lit("").alias("departure_time"),
    )
    names = {
        key: third.otherwise((F.col("id") % 500).cast("string")) if hot == key else F.lit("x")
        for key in ("route_id", "service_id")
    }
    trips = rows_.select(trip.alias("trip_id"), *(c.alias(k) for k, c in names.items())).distinct()
    routes = trips.select(
        "route_id", F.lit("U2").alias("route_short_name"), F.lit("400").alias("route_type")
    ).distinct()
    active = trips.select("service_id").distinct()
    with large_joins(spark):
        df = silver.transit_supply(stop_times, trips, routes, stops(spark), active, event)
        plan, result = ran(df)
    assert "BroadcastHashJoin" not in plan
    assert len(result) == n


def test_passes_are_cut_before_they_are_ranked_and_shuffled_once(spark, event):
    trips = spark.createDataFrame([("t", "r", "c")], "trip_id string, route_id string, service_id string")
    routes = spark.createDataFrame([("r", "U2", "400")], "route_id string, route_short_name string, route_type string")
    active = spark.createDataFrame([("c",)], "service_id string")
    with large_joins(spark):
        df = silver.transit_supply(passes(spark), trips, routes, stops(spark), active, event)
        plan = df._jdf.queryExecution().executedPlan().toString()
    # The rank within trip, stop and place uses the shuffle on the trip.
    assert "stop_sequence" in plan and not re.search(r"hashpartitioning\(trip_id#\d+, stop_id", plan)
    below_rank = plan.split("Window [row_number", 1)[1]
    assert "LeftSemi" in below_rank


def test_a_stop_with_a_third_of_all_delays_is_split(spark, event):
    updates = spark.range(0, 40_000, 1, 8).select(
        F.format_string(
            '{"trip":{"trip_id":"%d","route_id":"r"},"stop_time_update":'
            '[{"stop_id":"%s","arrival":{"delay":5}}]}',
            F.col("id"),
            hot_stop(F.col("id")),
        ).alias("payload_json"),
        F.lit("1784000000").alias("feed_timestamp"),
    )
    with large_joins(spark):
        plan, result = ran(silver.transit_delays(updates, stops(spark), event))
    assert "SortMergeJoin(skew=true)" in plan
    assert len(result) == 40_000


def test_the_timetable_cut_splits_a_busy_stop(spark):
    with large_joins(spark):
        plan, result = ran(timetable.referenced(passes(spark), stops(spark), "stop_id"))
    assert "SortMergeJoin(skew=true)" in plan
    assert len(result) == 40_000


def test_copies_of_one_key_shrink_before_the_shuffle(spark, event):
    """100,000 features without id leave each task as one row."""
    features = spark.range(0, 100_000, 1, 8).select(
        F.when(F.col("id") < 0, "x").otherwise("").alias("disruption_id"),
        F.format_string('{"properties":{"subtype":"%06d"}}', F.col("id")).alias("payload_json"),
    )
    plan, result = ran(silver.disruptions(features, event))
    assert [r.subtype for r in result] == ["099999"]
    final = plan.split("== Initial Plan ==")[0]
    below_shuffle = final.split("Exchange hashpartitioning(disruption_id")[1]
    assert "WindowGroupLimit" in below_shuffle and "Partial" in below_shuffle


def test_a_busy_cell_is_counted_exactly(spark):
    """One cell-hour with a third of the mentions, distinct users and all."""
    df = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("h3_index"),
        F.lit(10).alias("hour_of_day"),
        (F.col("id") % 7000).cast("string").alias("user_hash"),
        F.lit(0.5).alias("sentiment"),
        F.lit(True).alias("has_media"),
    )
    out = gold.mentions_by_cell_hour(df).where("h3_index = 'hot'")
    assert rows(out, "num_mentions", "num_users") == [(20_000, 7000)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


@pytest.mark.parametrize(
    "name",
    ["silver_bikes", "silver_delays", "silver_disruptions", "silver_supply", "silver_mentions",
     "mobility_vs_activity", "station_services", "transit_capacity", "line_reliability",
     "training_features", "category_examples", "generated_mentions", "timetable_semijoin_cascade"],
)
def test_plans_stay_in_the_jvm_and_have_no_cross_joins(spark, name):
    df = QUERIES[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for slow in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct",
                 "BroadcastNestedLoopJoin"):
        assert slow not in plan


def test_examples_are_cut_before_the_shuffle(spark):
    """A category with most of the examples sends n of them per task."""
    df = spark.range(0, 50_000, 1, 8).select(
        F.when(F.col("id") % 3 > 0, "large").otherwise("small").alias("mode"),
        F.format_string("%06d", F.col("id")).alias("name"),
    )
    plan, result = ran(profile.category_examples(df, "mode", "name", 3))
    assert sorted(tuple(r) for r in result) == [
        ("large", 33_333, ["000001", "000002", "000004"]),
        ("small", 16_667, ["000000", "000003", "000006"]),
    ]
    final = plan.split("== Initial Plan ==")[0]
    cut = final.split("WindowGroupLimit [mode")
    assert len(cut) == 3 and "Exchange hashpartitioning(mode" in cut[1]


def test_pressure_joins_without_another_shuffle(spark, event):
    """Both sides are aggregated on the join key: two shuffles, none for the join."""
    bikes = spark.createDataFrame(
        [("a", None, 1, 2)],
        "h3_index string, reading_ts timestamp, num_bikes_available int, num_docks_available int",
    )
    delays = spark.createDataFrame(
        [("a", None, 1)], "h3_index string, feed_ts timestamp, delay_seconds int"
    )
    plan, _ = ran(gold.mobility_pressure(bikes, delays, event))
    initial = plan.split("== Initial Plan ==")[1]
    assert initial.count("Exchange hashpartitioning") == 2


def test_scans_read_only_the_columns_they_need(spark):
    df = QUERIES["active_service_ids"](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    schemas = [line.split("ReadSchema: ")[1] for line in plan.splitlines() if "ReadSchema" in line]
    assert schemas and all(s.startswith("struct<o_custkey:bigint,o_orderpriority") for s in schemas)


@pytest.mark.parametrize("table", ["mentions", "trip_updates", "station_status", "stop_times", "trips", "features"])
def test_bronze_is_built_by_all_cores(spark, table):
    """A file of one split is spread over tasks before its rows are built, so none builds and writes all."""
    make = getattr(testdata, table)
    found = make(spark, SMALL, spread=True)
    sizes = found.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > spark.sparkContext.defaultParallelism
    assert sum(r["count"] for r in sizes) == make(spark, SMALL).count()

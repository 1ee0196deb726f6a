"""Generation and streaming of mentions."""

import json
import pathlib

import pytest
from pyspark.sql import functions as F

from frames import rows
from plazaflow.functions.draws import pick_weighted, pseudonym
from plazaflow.operators.silver import mentions
from plazaflow.sources.contracts import MENTIONS
from plazaflow.sources.lake import Lake
from plazaflow.sources.mentions import generate_mentions, land_mentions
from plazaflow.streaming.mentions import ingest_mentions, read_mentions_stream


def test_mentions_depend_on_their_number_only(spark, event):
    whole = rows(generate_mentions(spark, 300, event, partitions=1))
    assert whole == rows(generate_mentions(spark, 300, event, partitions=7))
    halves = generate_mentions(spark, 150, event).union(
        generate_mentions(spark, 150, event, first=151)
    )
    assert whole == rows(halves)


def test_generated_values(spark, event):
    df = generate_mentions(spark, 4000, event, partitions=4).cache()
    assert df.columns == MENTIONS.fieldNames()
    assert df.select("mention_id").distinct().count() == 4000
    assert df.select("user_hash").distinct().count() <= event.num_users
    assert df.where("not sentiment between -1 and 1").count() == 0
    assert df.where("event_ts not like '2026-09-14T__:__:__'").count() == 0
    hours = dict(rows(df.groupBy(F.hour(F.col("event_ts").cast("timestamp")).alias("h")).count()))
    assert not set(hours) & {h for h, w in enumerate(event.hour_weights) if w == 0}
    assert hours[15] == pytest.approx(4000 * 40 / sum(event.hour_weights), rel=0.2)
    means = df.agg(F.avg("sentiment"), F.avg(F.col("has_media").cast("int"))).head()
    assert means[0] == pytest.approx(0.35, abs=0.03)
    assert means[1] == pytest.approx(0.4, abs=0.03)


def test_mentions_scatter_equally_in_metres(spark, event):
    from dataclasses import replace

    one_point = replace(event, route=((52.51, 13.4),))
    spread = generate_mentions(spark, 4000, one_point).agg(
        F.stddev(F.col("lat") * 111320.0), F.stddev(F.col("lon") * one_point.metres_per_degree_lon)
    )
    assert list(spread.head()) == pytest.approx([300.0, 300.0], rel=0.05)


def test_weighted_pick_covers_its_range(spark):
    df = spark.range(1000).select(pick_weighted((F.col("id") + 0.5) / 1000, [0, 1, 3, 0]).alias("h"))
    assert rows(df.groupBy("h").count()) == [(1, 250), (2, 750)]


def test_pseudonyms_are_stable_and_distinct(spark):
    df = spark.range(100).select(pseudonym(F.col("id"), "salt").alias("h"))
    assert df.distinct().count() == 100
    assert df.where("h rlike '^[0-9a-f]{16}$'").count() == 100
    assert rows(df) == rows(df)
    assert not set(rows(df)) & set(rows(spark.range(100).select(pseudonym(F.col("id"), "other"))))


def write_lines(lake, name, *objects):
    folder = pathlib.Path(lake.landing("mentions"))
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(o) for o in objects), encoding="utf-8")


def made(first, n):
    return [{"mention_id": f"m{i}", "lat": 52.5, "lon": 13.4, "event_ts": "2026-09-14T10:00:00"}
            for i in range(first, first + n)]


def test_each_run_reads_only_new_files(spark, lake):
    write_lines(lake, "1.json", *made(0, 10))
    write_lines(lake, "2.json", *made(10, 10))
    assert ingest_mentions(lake) == 20
    write_lines(lake, "3.json", *made(20, 10))
    # A new Lake object stands for a new process: the checkpoint is what remembers.
    assert ingest_mentions(Lake(spark, lake.root), files_per_batch=1) == 10
    assert ingest_mentions(lake) == 0
    assert lake.read("bronze", "bronze_csd_mentions").count() == 30


def test_small_batches_read_everything(spark, lake):
    for i in range(4):
        write_lines(lake, f"{i}.json", *made(10 * i, 10))
    assert ingest_mentions(lake, files_per_batch=1) == 40


def test_a_bad_field_is_null_and_its_row_kept(spark, lake):
    write_lines(lake, "1.json", {"mention_id": "bad", "lat": "north", "lon": 13.4})
    ingest_mentions(lake)
    table = lake.read("bronze", "bronze_csd_mentions")
    assert rows(table, "mention_id", "lat", "lon", "source") == [("bad", None, 13.4, "synthetic")]


def test_a_lost_checkpoint_is_repaired_by_silver(spark, lake, event):
    write_lines(lake, "1.json", *made(0, 10))
    ingest_mentions(lake)
    stream = read_mentions_stream(spark, lake.landing("mentions"))
    lake.append_stream(stream, "bronze_csd_mentions", "synthetic", checkpoint="fresh")
    bronze = lake.read("bronze", "bronze_csd_mentions")
    assert bronze.count() == 20
    assert mentions(bronze, event).count() == 10


def test_landing_twice_adds_nothing(spark, lake, event):
    assert land_mentions(lake, event, batches=3, per_batch=20) == 60
    assert ingest_mentions(lake) == 60
    assert land_mentions(lake, event, batches=4, per_batch=20) == 20
    assert ingest_mentions(lake) == 20
    assert ingest_mentions(lake) == 0
    table = lake.read("bronze", "bronze_csd_mentions")
    assert (table.count(), table.select("mention_id").distinct().count()) == (80, 80)


def test_a_batch_that_was_cut_off_is_landed_again(spark, lake, event):
    land_mentions(lake, event, batches=1, per_batch=20)
    for mark in pathlib.Path(lake.landing("mentions")).rglob("*_SUCCESS*"):
        mark.unlink()
    assert land_mentions(lake, event, batches=1, per_batch=20) == 20


def test_tasks_follow_the_number_of_mentions(spark, event):
    assert generate_mentions(spark, 100, event).rdd.getNumPartitions() == 1
    assert generate_mentions(spark, 250_000, event).rdd.getNumPartitions() == 3

import json
import pathlib

import pytest

from frames import rows
from pyspark.sql import functions as F

from plazaflow.plans import queries
from plazaflow.plans.queries import _landed
from plazaflow.sources import feeds


def documents(spark, *payloads):
    return spark.createDataFrame(
        [(json.dumps(p), f"d{i}") for i, p in enumerate(payloads)],
        "document string, source_url string",
    )


def land(lake, feed, name, payload):
    folder = pathlib.Path(lake.landing(feed))
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps(payload, indent=1), encoding="utf-8")


def test_stations(spark):
    payload = {
        "last_updated": 17,
        "data": {"stations": [{"station_id": "1", "extra": {"deep": [1, 2]}}, {"lat": 1.5}]},
    }
    out = feeds.station_rows(documents(spark, payload)).collect()
    assert [(r.station_id, r.source_url, r.feed_last_updated) for r in out] == [
        ("1", "d0", "17"), ("", "d0", "17"),
    ]
    assert json.loads(out[0].payload_json) == payload["data"]["stations"][0]


def test_numeric_station_ids_are_text(spark):
    out = feeds.station_rows(documents(spark, {"data": {"stations": [{"station_id": 7}]}}))
    assert rows(out, "station_id", "feed_last_updated") == [("7", "")]


def test_features(spark):
    feature = {"properties": {"id": "x/1"}, "geometry": {"type": "Point", "coordinates": [1.5, 2]}}
    bare = {"properties": {}, "geometry": None}
    out = feeds.disruption_rows(documents(spark, {"features": [feature, bare]}, {})).collect()
    assert [r.disruption_id for r in out] == ["x/1", ""]
    assert json.loads(out[0].payload_json) == feature


def test_only_trip_updates(spark):
    payload = {
        "header": {"timestamp": "1784000000"},
        "entity": [
            {"id": "a", "trip_update": {"trip": {"trip_id": "t"}}},
            {"id": "b", "vehicle": {}},
            {"id": "c", "alert": {}},
        ],
    }
    out = feeds.trip_update_rows(documents(spark, payload, {"entity": []}))
    assert rows(out, "entity_id", "feed_timestamp") == [("a", "1784000000")]


def discovery(*languages):
    return {
        "data": {
            lang: {"feeds": [{"name": "station_status", "url": f"u/{lang}"}]} for lang in languages
        }
    }


def test_feed_url_in_the_wanted_or_first_language(spark):
    assert feeds.find_feed_url(documents(spark, discovery("de", "en")), "station_status") == "u/en"
    assert feeds.find_feed_url(documents(spark, discovery("pl", "de")), "station_status") == "u/pl"
    with pytest.raises(ValueError):
        feeds.find_feed_url(documents(spark, discovery("de")), "free_bike_status")


def test_many_small_documents_are_one_commit(spark, lake):
    """Batches are bounded by bytes, and files hold sequences of documents, or one over many lines."""
    n = 1100
    text = F.concat(F.lit('{"data":{"stations":[{"station_id":"'), "id", F.lit('"}]}}'))
    documents = spark.range(n, numPartitions=4).select(text.alias("document"), F.col("id").cast("string").alias("source_url"))
    _landed(documents, lake.landing("gbfs_status"))
    assert len(list(pathlib.Path(lake.landing("gbfs_status")).glob("*.txt"))) == 4
    land(lake, "gbfs_status", "alone.json", {"data": {"stations": [{"station_id": "alone"}]}})
    for i in range(1100):
        land(lake, "gbfs_status", f"{i}.json", {"data": {"stations": []}})
    assert feeds.ingest_feed(lake, "gbfs_status") == n + 1
    assert len(lake.parts("bronze", "bronze_nextbike_status")) == 1


def test_a_run_ingests_only_documents_landed_since_the_last(spark, lake):
    one = {"last_updated": 1, "data": {"stations": [{"station_id": "1"}, {"station_id": "2"}]}}
    land(lake, "gbfs_status", "a.json", one)
    assert feeds.ingest_feed(lake, "gbfs_status") == 2
    assert feeds.ingest_feed(lake, "gbfs_status") == 0
    land(lake, "gbfs_status", "b.json", {**one, "last_updated": 2})
    assert feeds.ingest_feed(lake, "gbfs_status") == 2
    table = lake.read("bronze", "bronze_nextbike_status")
    assert rows(table, "station_id", "feed_last_updated", "source") == [
        ("1", "1", "real"), ("1", "2", "real"), ("2", "1", "real"), ("2", "2", "real"),
    ]


def test_an_empty_feed_writes_nothing(spark, lake):
    land(lake, "viz", "a.json", {"features": []})
    assert feeds.ingest_feed(lake, "viz") == 0
    assert not lake.exists("bronze", "bronze_viz_disruptions")
    assert lake.commits().count() == 0


def test_landed_documents_are_packed_and_read_back_whole(spark, tmp_path):
    elements = F.repeat(F.lit('{"a":\n1},'), 50)
    docs = spark.range(0, 1000, 1, 1).select(F.concat(F.lit('{"features":['), elements, F.col("id"), F.lit("]}")).alias("document"))
    _landed(docs, str(tmp_path / "landed"), **queries.LANDED | {"maxRecordsPerFile": 300})
    files = list((tmp_path / "landed").glob("part-*"))
    text = docs.agg(F.sum(F.octet_length("document"))).first()[0]
    assert len(files) >= 4 and sum(f.stat().st_size for f in files) < text / 4
    found = feeds.read_documents(spark, str(tmp_path / "landed")).select("document")
    assert found.count() == 1000 and found.exceptAll(docs).isEmpty()

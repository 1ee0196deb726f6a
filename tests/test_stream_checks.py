"""Replays and bad records in the stream of mentions."""

import json
import os
import time

from frames import rows

from plazaflow.sources.lake import configured
from plazaflow.streaming import mentions as m


def line(i, **changes):
    row = {"mention_id": f"m{i}", "event_ts": "2026-09-14T10:00:00", "lat": 52.5, "lon": 13.4, "platform": "x",
           "language": "de", "sentiment": 0.1, "has_media": True, "user_hash": "u"}
    return json.dumps(row | changes)


def land(lake, name, *lines):
    folder = lake.landing("mentions")
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as f:
        f.write("\n".join(lines) + "\n")


def test_a_replayed_file_adds_nothing(lake):
    land(lake, "a", line(1), line(2), line(2))
    assert m.ingest_checked_mentions(lake) == {m.TABLE: 2, m.REJECTED: 0}
    land(lake, "b", line(2), line(1, lat=1.0), line(3))
    assert m.ingest_checked_mentions(lake) == {m.TABLE: 1, m.REJECTED: 0}
    assert m.ingest_checked_mentions(lake) == {m.TABLE: 0, m.REJECTED: 0}
    kept = lake.read("bronze", m.TABLE)
    assert rows(kept, "mention_id", "lat") == [("m1", 52.5), ("m2", 52.5), ("m3", 52.5)]
    assert m.RAW not in kept.columns


def test_bad_records_are_set_aside_whole(lake):
    bad = ['{"mention_id": "m9", "event_ts": ', "no json", "no json", line(4, mention_id=None), line(5, mention_id=""), line(6, lat="north")]
    land(lake, "mixed", line(1), *bad)
    land(lake, "other", "[1, 2", line(2))
    counts = m.ingest_checked_mentions(lake)
    assert counts == {m.TABLE: 3, m.REJECTED: 7}
    aside = lake.read("bronze", m.REJECTED)
    by_file = {(r.file_name.rsplit("/", 1)[1], r.reason): r.num_records for r in m.rejects_by_file(aside).collect()}
    assert by_file[("mixed.json", "no id")] == 2
    assert by_file[("mixed.json", "field")] == 1
    assert by_file[("mixed.json", "broken")] == 3
    assert by_file[("other.json", "broken")] == 1
    assert [r[0] for r in rows(aside.where("reason = 'broken'"), "raw_json")].count("no json") == 2
    kept = {r.mention_id: r for r in lake.read("bronze", m.TABLE).collect()}
    assert set(kept) == {"m1", "m2", "m6"}
    assert kept["m6"].lat is None and kept["m6"].lon == 13.4


def test_late_events_are_kept(lake):
    """Only the time of arrival counts, so an old event after a new one is no replay."""
    land(lake, "a", line(1, event_ts="2026-09-14T23:00:00"))
    m.ingest_checked_mentions(lake, remembered="1 second")
    land(lake, "b", line(2, event_ts="2019-01-01T00:00:00"), line(3, event_ts=None))
    assert m.ingest_checked_mentions(lake, remembered="1 second")[m.TABLE] == 2


def test_state_stays_bounded(spark, lake):
    for k in range(20):
        land(lake, f"f{k:02d}", *(line(100 * k + i) for i in range(50)))
    stream = m.read_checked_stream(spark, lake.landing("mentions"), files_per_batch=1)
    seen = []

    def slow(batch, number):
        seen.append(batch.count())
        time.sleep(0.2)

    with configured(spark, m.STATE_ON_DISK):
        query = (
            m.without_replays(stream, "mention_id", "1 second")
            .writeStream.foreachBatch(slow)
            .option("checkpointLocation", lake.checkpoint("bounded"))
            .trigger(availableNow=True)
            .start()
        )
    query.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert sum(seen) == 1000
    assert len(held) >= 20 and max(held) < 600
    assert "RocksDB" not in (spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") or "")

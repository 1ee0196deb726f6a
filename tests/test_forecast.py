import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from frames import rows
from plazaflow.operators import features as feat
from plazaflow.operators import forecast

RELIABILITY = (
    "route_id string, service_date date, hour_of_day int, avg_delay_seconds double,"
    " pct_on_time double, num_updates bigint"
)
DAY = dt.date(2026, 9, 13)  # a Sunday
FAST = forecast.ForestSettings(trees=5, depth=4)


def reliability(spark, *slots):
    return spark.createDataFrame(
        [(r, DAY + dt.timedelta(days=h // 24), h % 24, float(d), 0.5, 3) for r, h, d in slots],
        RELIABILITY,
    )


def test_the_first_slot_of_a_line_is_left_out(spark):
    slots = [("a", 8, 10), ("a", 9, 20), ("a", 12, 30), ("b", 8, 1), ("b", 33, 2), ("c", 1, 1)]
    out = feat.training_features(reliability(spark, *slots))
    assert rows(out, "route_id", "delay_lag_seconds", "gap_hours", "day_of_week", "avg_delay_seconds") == [
        ("a", 10.0, 1.0, 1, 20.0), ("a", 20.0, 3.0, 1, 30.0), ("b", 1.0, 25.0, 2, 2.0),
    ]


def test_scoring_looks_one_hour_past_the_latest_slot(spark):
    out = feat.scoring_features(reliability(spark, ("a", 8, 10), ("a", 23, 20)))
    assert rows(out, "slot_ts", "service_date", "hour_of_day", "day_of_week", "delay_lag_seconds", "gap_hours") == [
        (dt.datetime(2026, 9, 14), dt.date(2026, 9, 14), 0, 2, 20.0, 1.0)
    ]


@settings(max_examples=8, deadline=None)
@given(
    st.lists(st.integers(0, 200), min_size=1, max_size=30), st.sampled_from([0.0, 0.5, 0.8, 1.0])
)
def test_split_leaves_a_slot_on_each_side(spark, hours, share):
    df = spark.createDataFrame(
        [(dt.datetime(2026, 9, 1) + dt.timedelta(hours=h),) for h in hours], "slot_ts timestamp"
    )
    slots = sorted(set(hours))
    if len(slots) < 2:
        with pytest.raises(RuntimeError):
            feat.temporal_split(df, share)
        return
    cut = slots[max(1, min(int(len(slots) * share), len(slots) - 1)) - 1]
    split = feat.temporal_split(df, share)
    assert split.train.count() == sum(h <= cut for h in hours)
    assert split.validation.count() == sum(h > cut for h in hours)


def test_features_can_be_put_in_time_order(spark):
    slots = [("b", 8, 1), ("b", 9, 2), ("a", 8, 1), ("a", 9, 3), ("a", 10, 4)]
    ordered = feat.in_time_order(feat.training_features(reliability(spark, *slots)))
    assert [(r.slot_ts.hour, r.route_id) for r in ordered.collect()] == [
        (9, "a"), (9, "b"), (10, "a"),
    ]


def test_persistence_errors(spark):
    df = spark.createDataFrame([(10.0, 13.0), (20.0, 16.0)], "avg_delay_seconds double, delay_lag_seconds double")
    assert [tuple(r) for r in forecast.persistence_errors(df).collect()] == [(3.5, 3.54)]


@pytest.fixture(scope="module")
def history(spark):
    # Line a runs on time, line b is late in the evening.
    slots = [(r, h, 30 if r == "a" else 40 + 10 * (h % 24)) for r in "ab" for h in range(100)]
    return reliability(spark, *slots)


def test_training_judging_and_publishing(spark, lake, history):
    model, report = forecast.train(feat.training_features(history), FAST)
    parts = {r.part: r for r in report.collect()}
    assert set(parts) == {"validation", "baseline", "training"}
    assert parts["training"].num_rows + parts["validation"].num_rows == 198
    assert parts["training"].last_slot < parts["validation"].first_slot
    with pytest.raises(RuntimeError):
        forecast.load_model(lake)
    forecast.save_model(lake, model, report)
    assert spark.read.json(f"{lake.models}/delay_model_metrics").count() == 3

    strange = reliability(spark, ("never seen", 5, 60))
    out = forecast.predictions(forecast.load_model(lake), history.union(strange))
    assert out.columns == [
        "route_id", "predicted_for_ts", "hour_of_day", "predicted_delay_seconds",
        "last_observed_delay_seconds", "predicted_at", "source",
    ]
    found = {r.route_id: r for r in out.collect()}
    assert set(found) == {"a", "b", "never seen"}
    assert found["a"].predicted_delay_seconds == pytest.approx(30, abs=15)
    assert found["a"].predicted_for_ts == dt.datetime(2026, 9, 17, 4)
    assert found["never seen"].last_observed_delay_seconds == 60


def test_the_forest_does_not_depend_on_the_partitions_it_gets(spark, history):
    features = feat.training_features(history)
    found = []
    for partitions in (1, 7):
        model, _ = forecast.train(features.repartition(partitions), FAST)
        rows_ = model.transform(features).select("route_id", "slot_ts", "prediction").collect()
        found.append({(r[0], r[1]): r[2] for r in rows_})
    assert found[0] == pytest.approx(found[1])


def test_a_damaged_model_is_not_a_missing_one(spark, lake):
    spark.range(1).write.json(f"{lake.models}/{forecast.MODEL_NAME}")
    with pytest.raises(Exception) as e:
        forecast.load_model(lake)
    assert "no trained model" not in str(e.value)


def test_too_little_history_is_refused(spark, history):
    few = feat.training_features(history.where(F.col("service_date") == DAY))
    with pytest.raises(RuntimeError, match="training rows"):
        forecast.train(few, FAST)

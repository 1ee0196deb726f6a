"""Features of the next-hour delay forecast, from gold line reliability."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Names of the target and the features.
TARGET = "avg_delay_seconds"
CATEGORY = "route_id"
NUMERIC = [
    "hour_of_day",
    "day_of_week",
    "delay_lag_seconds",
    "pct_on_time_lag",
    "num_updates_lag",
    "gap_hours",
]
SCORING_COLUMNS = ["route_id", "service_date", "slot_ts", *NUMERIC]
TRAINING_COLUMNS = [*SCORING_COLUMNS, TARGET]


def with_slot(reliability: DataFrame) -> DataFrame:
    """Adds `slot_ts`, the instant of a service date and hour."""
    return reliability.withColumn(
        "slot_ts",
        F.timestamp_add("HOUR", F.col("hour_of_day"), F.col("service_date").cast("timestamp")),
    )


def previous_slot(slots: DataFrame) -> DataFrame:
    """Each slot with the values of the same line's previous observed slot and the hours between.

    A line has one row per hour of its history, so a window group is bounded by the length of the
    history however unequal the raw feed is.
    """
    by_line = Window.partitionBy("route_id").orderBy("slot_ts")
    lags = {
        "previous_slot_ts": F.lag("slot_ts").over(by_line),
        "delay_lag_seconds": F.lag(TARGET).over(by_line),
        "pct_on_time_lag": F.lag("pct_on_time").over(by_line),
        "num_updates_lag": F.lag("num_updates").over(by_line),
    }
    seconds = F.unix_timestamp("slot_ts") - F.unix_timestamp("previous_slot_ts")
    return slots.withColumns(lags).withColumn("gap_hours", seconds / 3600.0)


def training_features(reliability: DataFrame) -> DataFrame:
    """One row per line and slot; the first slot of a line has nothing before it and is left out."""
    return (
        previous_slot(with_slot(reliability))
        .where(F.col("delay_lag_seconds").isNotNull())
        .withColumn("day_of_week", F.dayofweek("service_date"))
        .select(*TRAINING_COLUMNS)
    )


def scoring_features(reliability: DataFrame) -> DataFrame:
    """One row per line: its latest slot, as the previous slot of the hour to forecast."""
    latest_first = Window.partitionBy("route_id").orderBy(F.desc("slot_ts"))
    latest = (
        with_slot(reliability).withColumn("_rank", F.row_number().over(latest_first))
    ).where("_rank = 1")
    ahead = F.timestamp_add("HOUR", F.lit(1), F.col("slot_ts"))
    return latest.select(
        "route_id",
        F.to_date(ahead).alias("service_date"),
        ahead.alias("slot_ts"),
        F.hour(ahead).alias("hour_of_day"),
        F.dayofweek(ahead).alias("day_of_week"),
        F.col(TARGET).alias("delay_lag_seconds"),
        F.col("pct_on_time").alias("pct_on_time_lag"),
        F.col("num_updates").alias("num_updates_lag"),
        F.lit(1.0).alias("gap_hours"),
    )


@dataclass(frozen=True)
class TimeSplit:
    """A cut in time: slots up to `cut` train, later ones validate."""

    train: DataFrame
    validation: DataFrame


def _hour(slot: str) -> Column:
    return F.date_trunc("HOUR", slot)


def split_point(features: DataFrame, train_share: float = 0.8) -> DataFrame:
    """One row, `num_slots` and `cut`: the last slot of the training part.

    At least one slot stays on each side. Slots are cut to whole hours, so their distinct values
    number at most 8,784 per year of history: the one array they are gathered in stays small at any
    feed volume, and duplicates are removed in every task before.
    """
    slots = features.agg(F.array_sort(F.collect_set(_hour("slot_ts"))).alias("slots"))
    n = F.size("slots")
    position = F.greatest(F.lit(1), F.least(F.floor(n * F.lit(train_share)).cast("int"), n - 1))
    return slots.select(
        n.alias("num_slots"), F.when(n >= 2, F.try_element_at("slots", position)).alias("cut")
    )


def temporal_split(features: DataFrame, train_share: float = 0.8) -> TimeSplit:
    """Splits by time, never at random; fewer than two slots cannot be split."""
    found = split_point(features, train_share).head()
    if found["cut"] is None:
        raise RuntimeError(
            f"{found['num_slots']} distinct slot(s): a split in time needs at least two"
        )
    cut = F.lit(found["cut"])
    return TimeSplit(
        train=features.where(_hour("slot_ts") <= cut),
        validation=features.where(_hour("slot_ts") > cut),
    )


def in_time_order(features: DataFrame) -> DataFrame:
    """Features sorted by slot, then line, for export."""
    return features.orderBy("slot_ts", "route_id")

"""Read-only questions about any lake table: volumes, categories, duplicates, previews."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOUR_COLUMNS = ("hour_of_day", "scheduled_hour")


def volume(df: DataFrame, axis: Column | str) -> DataFrame:
    """axis, num_rows."""
    by = F.col(axis) if isinstance(axis, str) else axis
    return df.groupBy(by.alias("axis")).agg(F.count("*").alias("num_rows"))


def volume_by_date(df: DataFrame, column: str) -> DataFrame:
    """Rows per date of a date, timestamp or ISO text column, in date order."""
    return volume(df, F.col(column).try_cast("date")).orderBy("axis")


def volume_by_station(df: DataFrame, column: str) -> DataFrame:
    """Rows per station, largest first."""
    return volume(df, column).orderBy(F.desc("num_rows"), "axis")


def volume_by_hour(df: DataFrame, column: str) -> DataFrame:
    """Rows per hour, in hour order."""
    return volume(df, column).orderBy("axis")


def numeric_profile(df: DataFrame, metric: str, distinct: Sequence[str]) -> DataFrame:
    """One row: rows, distinct keys, and the range and mean of a metric."""
    return df.agg(
        F.count("*").alias("num_rows"),
        F.count_distinct(*distinct).alias("num_distinct"),
        F.min(metric).alias("min_value"),
        F.max(metric).alias("max_value"),
        F.avg(metric).alias("avg_value"),
    )


def category_examples(df: DataFrame, category: str, example: str, n: int = 5) -> DataFrame:
    """Rows per category and its `n` smallest distinct examples, in order.

    Examples are made distinct and ranked; the rank limit is applied in every task before the
    shuffle, so no task ever holds all examples of a large category.
    """
    pairs = df.groupBy(category, example).agg(F.count("*").alias("rows"))
    smallest = Window.partitionBy(category).orderBy(F.col(example).asc_nulls_last())
    examples = (
        pairs.where(F.col(example).isNotNull())
        .withColumn("_rank", F.row_number().over(smallest))
        .where(F.col("_rank") <= n)
        .groupBy(F.col(category).alias("_category"))
        .agg(F.array_sort(F.collect_list(example)).alias("examples"))
    )
    counts = pairs.groupBy(category).agg(F.sum("rows").alias("num_rows"))
    return counts.join(
        examples, F.col(category).eqNullSafe(F.col("_category")), "left"
    ).select(category, "num_rows", F.coalesce("examples", F.array()).alias("examples"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, and how often."""
    return df.groupBy(*keys).agg(F.count("*").alias("num_rows")).where("num_rows > 1")


def hour_column(df: DataFrame) -> str | None:
    """The table's hour column, if it has one."""
    return next((c for c in HOUR_COLUMNS if c in df.columns), None)


def hourly_mean(df: DataFrame, metric: str) -> DataFrame:
    """Mean of a metric per hour, in hour order; the metric cannot be the hour itself."""
    hour = hour_column(df)
    if hour is None or metric == hour:
        raise ValueError(f"{metric!r} has no hour to be averaged over")
    return df.groupBy(hour).agg(F.avg(metric).alias(f"mean_{metric}")).orderBy(hour)


def hour_range(df: DataFrame, first: int, last: int) -> DataFrame:
    """Rows of the hours first to last; a table without hours is returned whole."""
    hour = hour_column(df)
    return df if hour is None else df.where(F.col(hour).between(first, last))


def table_summary(df: DataFrame) -> DataFrame:
    """One row: rows, and distinct cells where the table has cells."""
    cells = F.count_distinct("h3_index") if "h3_index" in df.columns else F.lit(None)
    return df.agg(
        F.count("*").alias("num_rows"), cells.cast("bigint").alias("num_cells")
    )


def date_range(
    df: DataFrame, column: str | None, first: dt.date | None, last: dt.date | None = None
) -> DataFrame:
    """Rows of the days first to last (one day when last is missing) that have a cell.

    A table without a date column is not cut by date; one without cells is not cut by cell.
    """
    if column is not None and first is not None:
        day = F.col(column).try_cast("date")
        df = df.where(day.between(F.lit(first), F.lit(last or first)))
    return df.where(F.col("h3_index").isNotNull()) if "h3_index" in df.columns else df


def top_rows(df: DataFrame, metric: str, n: int, ties: Sequence[str] = ()) -> DataFrame:
    """The n rows with the largest metric; `ties` makes the choice repeatable."""
    return df.orderBy(F.desc_nulls_last(metric), *ties).limit(n)


def serving_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first n rows in a stated order, for a table viewer, and whether there are more.

    One row more than wanted is taken; the window below sees at most these n + 1 rows.
    """
    some = df.orderBy(*order).limit(n + 1)
    everything = Window.partitionBy(F.lit(0))
    return (
        some.withColumn("truncated", F.count("*").over(everything) > n)
        .withColumn("_rank", F.row_number().over(everything.orderBy(*order)))
        .where(F.col("_rank") <= n)
        .drop("_rank")
    )

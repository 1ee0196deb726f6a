"""Which timetable services run on the event day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazaflow.config import EventConfig
from plazaflow.operators.dedup import distinct_join_keys

# Fixed values of the timetable format.
RUNS, ADDED, REMOVED = "1", "1", "2"


def active_services(
    calendar: DataFrame, calendar_dates: DataFrame, event: EventConfig
) -> DataFrame:
    """service_id, distinct: the weekly pattern plus added days, minus removed days.

    A removal wins over an addition.
    """
    day = F.lit(event.compact_day)
    weekly = calendar.where(
        (F.col(event.weekday) == RUNS) & day.between(F.col("start_date"), F.col("end_date"))
    ).select("service_id")
    today = calendar_dates.where(F.col("date") == day)
    added = today.where(F.col("exception_type") == ADDED).select("service_id")
    removed = today.where(F.col("exception_type") == REMOVED).select("service_id")
    running = distinct_join_keys(weekly.union(added), "service_id")
    return running.join(removed, "service_id", "left_anti")

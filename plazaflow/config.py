"""Event parameters and the Spark session.

Everything that ties the library to one event (date, route, grid, thresholds) is a field of
`EventConfig`; another event or city is another instance.
"""

from __future__ import annotations

import datetime as dt
import math
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

# Length of one degree of latitude, and the legal provenance tags.
METRES_PER_DEGREE = 111320.0
SOURCES = ("real", "synthetic")

# Columns of the timetable calendar, whatever the process locale.
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")

# Route of the default event, (lat, lon).
DEFAULT_ROUTE = (
    (52.5111, 13.4022),
    (52.4994, 13.3542),
    (52.5163, 13.3777),
)

# Relative weight of mentions for each hour of the day, 0 to 23.
DEFAULT_HOUR_WEIGHTS = (
    1, 1, 1, 0, 0, 0, 0, 1, 2, 4, 8, 14,
    22, 30, 38, 40, 36, 28, 20, 16, 14, 10, 6, 3,
)


@dataclass(frozen=True)
class EventConfig:
    """One event. Instances are small, immutable and safe to close over in plans."""

    day: dt.date = dt.date(2026, 9, 14)
    route: tuple[tuple[float, float], ...] = DEFAULT_ROUTE
    margin_km: float = 3.0
    reference_latitude: float = 52.51
    # Zone of the event's wall clock; instants are moved to it before an hour is taken.
    # None reads hours in the session time zone.
    time_zone: str | None = "Europe/Berlin"

    cell_edge_m: float = 174.0
    # "grid" is a planar hexagon grid around the event; "h3" has the ids of the worldwide H3 grid.
    cell_backend: str = "grid"
    h3_resolution: int = 9

    on_time_seconds: int = 60
    k_min: int = 5
    k_on: str = "mentions"  # or "users"
    # False: a disruption with a missing bound is never active. True: the bound is unlimited.
    open_ended: bool = False

    hour_weights: tuple[int, ...] = DEFAULT_HOUR_WEIGHTS
    jitter_m: float = 300.0
    num_users: int = 400
    salt: str = "event-mentions"
    seed: int = 417

    def __post_init__(self) -> None:
        if self.k_on not in ("mentions", "users"):
            raise ValueError(f"k_on must be 'mentions' or 'users', not {self.k_on!r}")
        if self.cell_backend not in ("grid", "h3"):
            raise ValueError(f"unknown cell backend {self.cell_backend!r}")
        if len(self.hour_weights) != 24 or sum(self.hour_weights) <= 0:
            raise ValueError("hour_weights needs 24 values with a positive sum")

    @property
    def weekday(self) -> str:
        """Name of the timetable calendar column of the event day."""
        return WEEKDAYS[self.day.weekday()]

    @property
    def compact_day(self) -> str:
        """Event day as timetables write it, yyyyMMdd."""
        return self.day.strftime("%Y%m%d")

    @property
    def metres_per_degree_lon(self) -> float:
        return METRES_PER_DEGREE * math.cos(math.radians(self.reference_latitude))


def build_session(app_name: str = "plazaflow", master: str | None = None) -> SparkSession:
    """Session with the settings the plans rely on.

    On a cluster `spark-submit` gives the master and resources; here only planner settings are
    set. Joins carry no broadcast hints: Spark broadcasts a side when its measured size is under
    `spark.sql.autoBroadcastJoinThreshold`, and otherwise AQE splits skewed shuffle partitions.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared checkpoint folder, or else below the warehouse.

    A cluster whose warehouse is a local folder and that names no checkpoint folder has no place
    that all executors see, which is an error.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        local = base.startswith(("file:", "/"))
        if local and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/plazaflow/{purpose}-{uuid.uuid4().hex}"

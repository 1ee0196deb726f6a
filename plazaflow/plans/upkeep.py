"""Silver kept up by change: a run reads the bronze commits since the last one, and writes the days they touch.

A silver row is the first of its key by a stated order, so the first of the rows kept before and the new ones is
the first of all. For each table a run

1. lists the commits of its facts that are not noted as taken in;
2. makes rows of them alone, one per key;
3. finds the days touched: those of the new rows, and those where silver already has one of their keys;
4. merges the new rows with silver's rows of these days, keeps the first of each key, and writes these days anew;
5. notes the commits.

A run that is cut off before the note takes the same commits in again, with the same result. If a
dimension that the rows are placed by has changed, or the table was never kept up, it is built from all of bronze.
Rows without a day (no time) have a folder of their own. Disruptions and the scheduled supply are built anew
only if one of their sources has changed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from plazaflow.config import EventConfig
from plazaflow.operators import silver
from plazaflow.operators.calendar import active_services
from plazaflow.operators.dedup import keep_first
from plazaflow.sources.lake import DAY, Lake

SNAPSHOT = "bronze_gtfs_static_"


@dataclass(frozen=True)
class Run:
    """What one run did: `mode` is full, days or none; the bronze rows read, and the rows written."""

    mode: str
    rows_read: int
    rows_written: int


@dataclass(frozen=True)
class Kept:
    """How a silver table is made of facts and dimensions."""

    facts: str
    dimensions: Sequence[str]
    rows: Callable[[DataFrame], DataFrame]
    placed: Callable[[DataFrame, Sequence[DataFrame], EventConfig], DataFrame]
    keys: Sequence[str]
    time: str
    largest: Sequence[str] = ()

    def day(self) -> Column:
        return F.to_date(self.time)


KEPT = {
    "silver_bike_availability": Kept(
        "bronze_nextbike_status",
        ["bronze_nextbike_station_information"],
        silver.bike_readings,
        lambda rows, dims, event: silver.placed_readings(rows, dims[0], event),
        ["station_id", "reading_ts"],
        "reading_ts",
    ),
    "silver_transit_delays": Kept(
        "bronze_gtfs_tripupdates",
        [f"{SNAPSHOT}stops"],
        silver.stop_delays,
        lambda rows, dims, event: silver.placed_delays(rows, dims[0], event),
        ["trip_id", "stop_id", "feed_ts"],
        "feed_ts",
        ["delay_seconds"],
    ),
    "silver_csd_mentions": Kept(
        "bronze_csd_mentions",
        [],
        silver.mention_rows,
        lambda rows, dims, event: silver.placed_mentions(rows, event),
        ["mention_id"],
        "event_ts",
    ),
}


def _noted(lake: Lake, table: str) -> dict[str, set[str]] | None:
    """Parts of each source that a table has taken in; None where it was never kept up."""
    path = f"{lake.root}/_progress/{table}"
    if not lake.has_folder(path):
        return None
    found: dict[str, set[str]] = {}
    for row in lake.spark.read.parquet(path).collect():  # names of folders
        found.setdefault(row.source_table, set()).add(row.part)
    return found


def _note(lake: Lake, table: str, parts: dict[str, list[str]], anew: bool) -> None:
    rows = [(source, part) for source, names in parts.items() for part in names]
    df = lake.spark.createDataFrame(rows, "source_table string, part string").coalesce(1)
    df.write.mode("overwrite" if anew else "append").parquet(f"{lake.root}/_progress/{table}")


def keep_up(lake: Lake, table: str, event: EventConfig) -> Run:
    """Brings one of the `KEPT` tables up to its sources."""
    how = KEPT[table]
    sources = {name: lake.parts("bronze", name) for name in (how.facts, *how.dimensions)}
    noted = _noted(lake, table)
    dims = [lake.read("bronze", name) for name in how.dimensions]

    def same(name: str) -> bool:
        return noted is not None and set(sources[name]) == noted.get(name, set())

    if noted is None or not all(map(same, how.dimensions)) or lake.fmt == "delta":
        return _built(lake, table, event, sources, dims)
    new = sorted(set(sources[how.facts]) - noted.get(how.facts, set()))
    if not new:
        return Run("none", 0, 0)

    seen = Observation()
    commits = lake.read_commits(how.facts, new).observe(seen, F.count("*").alias("rows"))
    # Read three times below, so written once, beside the lake's tables.
    staged = f"{lake.root}/_staged/{table}"
    rows = how.rows(commits)
    rows.withColumn(DAY, how.day()).write.mode("overwrite").parquet(staged)
    fresh = lake.spark.read.parquet(staged)

    before = lake.days("silver", table, how.placed(rows, dims, event).schema)
    touched = fresh.select(DAY).distinct()
    if how.time not in how.keys:  # a key may have come before, on another day
        known = before.select(*how.keys, DAY).join(fresh.select(*how.keys), list(how.keys), "left_semi")
        touched = touched.union(known.select(DAY)).distinct()
    days = {r[0] for r in touched.collect()}  # as many as there are folders
    dated = sorted(days - {None})
    here = F.col(DAY).isin(dated) if dated else F.lit(False)
    here = here | F.col(DAY).isNull() if None in days else here

    merged = before.where(here).select(*rows.columns).unionByName(fresh.select(*rows.columns))
    first = keep_first(merged, how.keys, largest=how.largest)
    left = Observation()
    placed = how.placed(first, dims, event).withColumn(DAY, how.day())
    written = lake.replace_days(placed.observe(left, F.collect_set(DAY).alias("days")), "silver", table)
    lake.drop_days("silver", table, set(dated) - set(left.get["days"]))
    _note(lake, table, {how.facts: new}, anew=False)
    return Run("days", seen.get["rows"], written)


def _built(lake: Lake, table: str, event: EventConfig, sources: dict[str, list[str]], dims: list[DataFrame]) -> Run:
    """The table from all of bronze."""
    how, seen = KEPT[table], Observation()
    facts = lake.read("bronze", how.facts).observe(seen, F.count("*").alias("rows"))
    placed = how.placed(how.rows(facts), dims, event)
    if lake.fmt == "delta":
        return Run("full", seen.get["rows"], lake.replace(placed, "silver", table))
    written = lake.replace_by_day(placed.withColumn(DAY, how.day()), "silver", table)
    if written:
        _note(lake, table, sources, anew=True)
    else:  # there is no day to begin with: the next run builds it again
        lake.replace(placed, "silver", table)
    return Run("full", seen.get["rows"], written)


def _changed(lake: Lake, table: str, sources: Sequence[str], build: Callable[[], DataFrame]) -> Run:
    """A table that is built anew where a source has changed."""
    parts = {name: lake.parts("bronze", name) for name in sources}
    noted = _noted(lake, table)
    if noted is not None and all(set(names) == noted.get(name, set()) for name, names in parts.items()):
        return Run("none", 0, 0)
    written = lake.replace(build(), "silver", table)
    _note(lake, table, parts, anew=True)
    return Run("full", sum(lake.read("bronze", name).count() for name in sources), written)


def silver_upkeep(lake: Lake, event: EventConfig) -> dict[str, Run]:
    """Brings all silver tables up to bronze."""

    def bronze(name: str) -> DataFrame:
        return lake.read("bronze", name)

    def supply() -> DataFrame:
        calendar, exceptions = (bronze(f"{SNAPSHOT}{n}") for n in ("calendar", "calendar_dates"))
        tables = [bronze(f"{SNAPSHOT}{n}") for n in ("stop_times", "trips", "routes", "stops")]
        return silver.transit_supply(*tables, active_services(calendar, exceptions, event), event)

    timetable = [f"{SNAPSHOT}{n}" for n in ("stop_times", "trips", "routes", "stops", "calendar", "calendar_dates")]
    runs = {table: keep_up(lake, table, event) for table in KEPT}
    runs["silver_disruptions"] = _changed(
        lake, "silver_disruptions", ["bronze_viz_disruptions"], lambda: silver.disruptions(bronze("bronze_viz_disruptions"), event)
    )
    runs["silver_transit_supply"] = _changed(lake, "silver_transit_supply", timetable, supply)
    return runs

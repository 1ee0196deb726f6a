"""What is in the lake: rows, columns and commits per table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazaflow.operators import profile
from plazaflow.sources.contracts import BY_NAME, CATALOGUE, TableInfo
from plazaflow.sources.lake import Lake

METRICS = "layer string, table_name string, num_rows bigint, num_columns int"


def _versions(lake: Lake, tables: Sequence[TableInfo]) -> DataFrame:
    """Commits per table: the table's own history where the format keeps one, else the audit."""
    if lake.fmt != "delta":
        return lake.commits()
    histories = [
        lake.spark.sql(f"DESCRIBE HISTORY delta.`{lake.path(t.layer, t.name)}`").agg(
            F.lit(t.layer).alias("layer"),
            F.lit(t.name).alias("table_name"),
            F.count("*").alias("num_versions"),
        )
        for t in tables
    ]
    return reduce(DataFrame.union, histories)


def inventory(lake: Lake, tables: Sequence[TableInfo] = CATALOGUE) -> DataFrame:
    """One row per existing table; missing tables are left out.

    All tables are counted by one job: the counts are branches of a single union, and a Parquet
    count reads footers only.
    """
    found = [(t, lake.find(t.layer, t.name)) for t in tables]
    found = [(t, df) for t, df in found if df is not None]
    if not found:
        counts = lake.spark.createDataFrame([], METRICS)
    else:
        counts = reduce(
            DataFrame.union,
            [
                df.agg(F.count("*").alias("num_rows")).select(
                    F.lit(t.layer).alias("layer"),
                    F.lit(t.name).alias("table_name"),
                    "num_rows",
                    F.lit(len(df.columns)).alias("num_columns"),
                )
                for t, df in found
            ],
        )
    versions = _versions(lake, [t for t, _ in found]) if found else lake.commits()
    return (
        counts.join(versions, ["layer", "table_name"], "left")
        .withColumn(
            "num_delta_versions", F.coalesce(F.col("num_versions"), F.lit(0)).cast("int")
        )
        .drop("num_versions")
        .withColumn("metrics_ts", F.current_timestamp())
    )


def volume_report(lake: Lake, tables: Sequence[TableInfo] = CATALOGUE) -> DataFrame:
    """layer, table_name, num_rows, state (filled, empty or missing) of every expected table."""
    expected = lake.spark.createDataFrame(
        [(i, t.layer, t.name) for i, t in enumerate(tables)],
        "position int, layer string, table_name string",
    )
    measured = inventory(lake, tables).select("layer", "table_name", "num_rows")
    state = (
        F.when(F.col("num_rows").isNull(), "missing")
        .when(F.col("num_rows") == 0, "empty")
        .otherwise("filled")
    )
    return (
        expected.join(measured, ["layer", "table_name"], "left")
        .withColumn("state", state)
        .orderBy("position")
        .drop("position")
    )


def breakdowns(lake: Lake, table: str) -> dict[str, DataFrame]:
    """The volume breakdowns the catalogue lists for a table."""
    info = _known(table)
    df = lake.read(info.layer, table)
    reports = {
        "date": (info.date, profile.volume_by_date),
        "station": (info.station, profile.volume_by_station),
        "hour": (info.hour, profile.volume_by_hour),
    }
    return {axis: make(df, column) for axis, (column, make) in reports.items() if column}


def inspect(lake: Lake, table: str, first=None, last=None) -> DataFrame | None:
    """Rows of a catalogued table within a range of days, with a cell; None when not written."""
    info = _known(table)
    df = lake.find(info.layer, table)
    return None if df is None else profile.date_range(df, info.date, first, last)


def _known(table: str) -> TableInfo:
    if table not in BY_NAME:
        raise ValueError(f"unknown table {table!r}; known: {sorted(BY_NAME)}")
    return BY_NAME[table]

"""The lake: every table read and write of the library goes through here.

Tables are folders `root/layer/table`. Parquet is the default; pass ``fmt="delta"`` where Delta is
on the classpath to get its transactions and history.

A Parquet table that is rebuilt is written to a version folder of its own. A version counts once
Spark has marked it as complete, so readers see the old table until the new one is whole, and a
rebuild that fails leaves the old one as it was. Appended Parquet tables hold a folder per commit.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import json
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plazaflow.config import SOURCES
from plazaflow.sources.contracts import LAYERS


def with_provenance(df: DataFrame, source: str) -> DataFrame:
    """Adds where a row comes from and when it was ingested. Works on batches and streams."""
    if source not in SOURCES:
        raise ValueError(f"source must be one of {SOURCES}, not {source!r}")
    return df.withColumns(
        {
            "source": F.lit(source),
            "ingest_ts": F.current_timestamp(),
            "ingest_date": F.current_date(),
        }
    )


@contextlib.contextmanager
def configured(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Session settings for a while; those before come back."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


# Folders of appended commits, of rebuilt versions, and of the days of a table that is kept up by day.
COMMIT = "_commit_id"
VERSION = "version-"
DAY = "_day"
# Bronze keeps payloads as JSON text, which this packs better than Spark's default.
CODEC = "zstd"
# A write that runs its plan once needs the shuffled rows no more when it ends; else they stay until the driver
# collects its garbage, those of all tables of a job together.
RELEASED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


class Lake:
    """Addressing, reading and writing of layered tables below one root folder."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fmt = fmt

    # -- addressing ----------------------------------------------------------------------

    def path(self, layer: str, table: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}; use one of {LAYERS}")
        return f"{self.root}/{layer}/{table}"

    def landing(self, feed: str) -> str:
        return f"{self.root}/landing/{feed}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/_checkpoints/{name}"

    @property
    def models(self) -> str:
        return f"{self.root}/models"

    @property
    def audit_path(self) -> str:
        return f"{self.root}/_audit"

    # -- reading -------------------------------------------------------------------------

    def read(self, layer: str, table: str, since: dt.date | None = None) -> DataFrame:
        """Scans a table; `since` keeps the bronze partitions ingested from that day on."""
        path = self.path(layer, table)
        if self.fmt != "delta":
            versions = self._versions(path)
            path = versions[-1] if versions else path
        df = self.spark.read.format(self.fmt).load(path).drop(COMMIT, DAY)
        if since is not None:
            df = df.where(F.col("ingest_date") >= F.lit(since))
        return df

    def find(self, layer: str, table: str) -> DataFrame | None:
        """The table, or None where it was never written. One that cannot be read is an error."""
        path = self.path(layer, table)
        if not self.has_folder(path):
            return None
        if self.fmt != "delta" and not self._versions(path) and not self._names(path, f"{COMMIT}="):
            return None  # its first rebuild did not come to an end
        return self.read(layer, table)

    def exists(self, layer: str, table: str) -> bool:
        return self.find(layer, table) is not None

    def _folder(self, path: str):
        """A path and its file system, local or shared; all use of Hadoop's files is by this."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder, folder.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def has_folder(self, path: str) -> bool:
        folder, files = self._folder(path)
        return files.exists(folder)

    def _names(self, path: str, prefix: str) -> list[str]:
        folder, files = self._folder(path)
        if not files.exists(folder):
            return []
        names = [x.getPath().getName() for x in files.listStatus(folder)]
        return sorted(x for x in names if x.startswith(prefix))

    def _versions(self, path: str) -> list[str]:
        """Folders of the complete versions of a rebuilt table, oldest first."""
        folders = [f"{path}/{name}" for name in self._names(path, VERSION)]
        return [x for x in folders if self.has_folder(f"{x}/_SUCCESS")]

    def parts(self, layer: str, table: str) -> list[str]:
        """Names of the complete commits of an appended table, or the version of a rebuilt one."""
        path = self.path(layer, table)
        versions = self._versions(path)
        if versions:
            return [versions[-1].rsplit("/", 1)[1]]
        names = self._names(path, f"{COMMIT}=")
        return [x for x in names if self.has_folder(f"{path}/{x}/_SUCCESS")]

    def read_commits(self, table: str, names: Sequence[str]) -> DataFrame:
        """The rows of some commits of a bronze table; no other file is listed or read."""
        path = self.path("bronze", table)
        reader = self.spark.read.format(self.fmt).option("basePath", path)
        return reader.load([f"{path}/{name}" for name in names]).drop(COMMIT)

    def days(self, layer: str, table: str, schema: T.StructType) -> DataFrame:
        """A table that is kept up by day, with the day of each row; its columns are given."""
        fields = T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])
        return self.spark.read.format(self.fmt).schema(fields).load(self._versions(self.path(layer, table))[-1])

    def drop_days(self, layer: str, table: str, days: Iterable[dt.date]) -> None:
        """Removes days that have no rows left."""
        path = self._versions(self.path(layer, table))[-1]
        for day in days:
            folder, files = self._folder(f"{path}/{DAY}={day.isoformat()}")
            files.delete(folder, True)

    def register_views(self, layer: str, *tables: str) -> None:
        """Makes tables available to `spark.sql` under their own names."""
        for table in tables:
            self.read(layer, table).createOrReplaceTempView(table)

    # -- writing -------------------------------------------------------------------------

    def append_bronze(self, df: DataFrame, table: str, source: str) -> int:
        """Appends events below a partition of their ingest date."""
        return self._append(with_provenance(df, source), table, uuid.uuid4().hex)

    def replace_bronze(self, df: DataFrame, table: str, source: str) -> int:
        """Replaces a snapshot source (a timetable, say) together with its schema."""
        return self._replace(with_provenance(df, source), "bronze", table)

    def replace(self, df: DataFrame, layer: str, table: str) -> int:
        """Rebuilds a silver or gold table, from other tables or from itself."""
        return self._replace(df, layer, table)

    def replace_days(self, df: DataFrame, layer: str, table: str) -> int:
        """Writes the days (column `DAY`) that the rows have anew; other days stay as they are.

        Files are staged and put in place when all tasks have ended, so the rows may come from the table
        itself, and a failed run changes nothing.
        """
        path = self._versions(self.path(layer, table))[-1]
        rows, writer = self._counted(df)
        writer = writer.option("partitionOverwriteMode", "dynamic").mode("overwrite")
        writer.partitionBy(DAY).save(path)
        return self.record(layer, table, "days", rows.get["rows"])

    def replace_by_day(self, df: DataFrame, layer: str, table: str) -> int:
        """Rebuilds a table with a folder for each day."""
        return self._replace(df, layer, table, by=[DAY])

    def _replace(self, df: DataFrame, layer: str, table: str, by: Sequence[str] = ()) -> int:
        path = self.path(layer, table)
        if self.fmt == "delta":
            rows, writer = self._counted(df)
            writer.mode("overwrite").option("overwriteSchema", "true").save(path)
        else:
            names = self._names(path, VERSION)
            number = 1 + max((int(x.removeprefix(VERSION)) for x in names), default=0)
            rows, writer = self._counted(df)
            writer = writer.partitionBy(*by) if by else writer
            with configured(df.sparkSession, RELEASED):
                writer.mode("error").save(f"{path}/{VERSION}{number:010d}")
            # The version before stays for readers that have begun with it.
            self._drop_versions(path, keep=2)
        return self.record(layer, table, "overwrite", rows.get["rows"])

    def _drop_versions(self, path: str, keep: int) -> None:
        kept = set(self._versions(path)[-keep:])
        for name in self._names(path, VERSION):
            if f"{path}/{name}" not in kept:
                folder, files = self._folder(f"{path}/{name}")
                files.delete(folder, True)

    def _append(self, df: DataFrame, table: str, commit: str, version: int | None = None) -> int:
        """Adds the rows of one commit; the same commit again takes the place of the first."""
        path = self.path("bronze", table)
        rows, writer = self._counted(df)
        writer = writer.partitionBy("ingest_date")
        if self.fmt == "delta":
            if version is not None:  # Delta skips a version that an application has written
                writer = writer.option("txnAppId", commit).option("txnVersion", str(version))
            writer.mode("append").save(path)
        else:
            folder = commit if version is None else f"{commit}-{version:010d}"
            writer.mode("overwrite").save(f"{path}/{COMMIT}={folder}")
            if not rows.get["rows"]:  # nothing but an empty folder was written
                location, files = self._folder(f"{path}/{COMMIT}={folder}")
                files.delete(location, True)
        found = rows.get["rows"]
        return self.record("bronze", table, "append", found) if found else 0

    def _counted(self, df: DataFrame):
        """A writer that counts: the row count rides along instead of running the plan again."""
        seen = Observation()
        writer = df.observe(seen, F.count("*").alias("rows")).write.format(self.fmt)
        return seen, writer.option("compression", CODEC) if self.fmt == "parquet" else writer

    def append_stream(
        self,
        stream: DataFrame,
        table: str,
        source: str,
        checkpoint: str | None = None,
    ) -> int:
        """Drains what is pending in a stream into bronze and stops; returns the rows added.

        The checkpoint remembers the files already read, so each run appends only new ones. A batch
        is a commit named by the stream and its number: one that was cut off takes its own place when
        it is repeated. After a lost checkpoint all files are read again as another stream; nothing is
        lost, and silver keeps one row per key.
        """
        routes = {table: lambda batch: batch}
        return self.append_routes(stream, routes, source, checkpoint or table)[table]

    def append_routes(
        self,
        stream: DataFrame,
        routes: Mapping[str, Callable[[DataFrame], DataFrame]],
        source: str,
        checkpoint: str,
        settings: Mapping[str, str] | None = None,
    ) -> dict[str, int]:
        """As `append_stream`, for tables that each take their rows from the same micro-batches.

        A batch that goes to several tables is kept until all are written, so it is read once.
        `settings` hold for this stream alone.
        """
        rows = dict.fromkeys(routes, 0)

        def append(batch: DataFrame, number: int) -> None:
            query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
            several = len(routes) > 1
            if several:
                batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
            try:
                for table, route in routes.items():
                    rows[table] += self._append(route(batch), table, query_id, number)
            finally:
                if several:
                    batch.unpersist()

        writer = (
            with_provenance(stream, source)
            .writeStream.foreachBatch(append)
            .option("checkpointLocation", self.checkpoint(checkpoint))
            .trigger(availableNow=True)
        )
        with configured(self.spark, settings or {}):
            query = writer.start()  # it keeps a copy of the session's settings
        query.awaitTermination()
        return rows

    # -- audit ---------------------------------------------------------------------------

    def record(self, layer: str, table: str, mode: str, rows: int) -> int:
        """Notes one committed write, for the commit count of tables that keep no history."""
        note = {"layer": layer, "table_name": table, "mode": mode, "num_rows": rows}
        note["written_at"] = dt.datetime.now(dt.timezone.utc).isoformat()
        target, files = self._folder(f"{self.audit_path}/{uuid.uuid4().hex}.json")
        out = files.create(target)
        try:
            out.write(bytearray(json.dumps(note).encode()))
        finally:
            out.close()
        return rows

    def commits(self) -> DataFrame:
        """layer, table_name, num_versions of every table ever written."""
        if not self.has_folder(self.audit_path):
            return self.spark.createDataFrame(
                [], "layer string, table_name string, num_versions bigint"
            )
        log = self.spark.read.schema("layer string, table_name string").json(self.audit_path)
        return log.groupBy("layer", "table_name").agg(F.count("*").alias("num_versions"))

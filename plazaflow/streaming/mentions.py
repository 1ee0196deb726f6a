"""Incremental ingest of landed mentions: replays left out, unreadable records set aside.

A record is set aside, whole and with its reason, where its line is no JSON object (`broken`) or it has
no id (`no id`). A record with an id and a field that does not parse is kept with that field null, and
noted as `field` beside the others.

Replays are told by the id within a time after its first arrival. The time is that of the micro-batch,
not the event's own, so no row ever comes too late and is dropped for it; ids older than that leave
the state, which is kept on the executors' disks (RocksDB) and in the checkpoint. What is replayed
later reaches bronze twice and becomes one row in silver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plazaflow.sources.contracts import MENTIONS
from plazaflow.sources.lake import Lake

# A backlog is drained in batches of this many files, so a failure repeats one batch at most.
FILES_PER_BATCH = 10_000
TABLE = "bronze_csd_mentions"
REJECTED = "bronze_csd_mentions_rejected"
RAW, REASON, FILE = "raw_json", "reason", "file_name"
REMEMBERED = "2 hours"

STATE_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    )
}


def read_mentions_stream(
    spark: SparkSession, folder: str, files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """Stream of JSON lines files, batch folders and all; a field that does not parse is null, its
    row is kept."""
    reader = spark.readStream.schema(MENTIONS).option("recursiveFileLookup", "true")
    return reader.option("maxFilesPerTrigger", str(files_per_batch)).json(folder)


def ingest_mentions(lake: Lake, files_per_batch: int = FILES_PER_BATCH) -> int:
    """Appends the mentions landed since the last run; returns how many."""
    stream = read_mentions_stream(lake.spark, lake.landing("mentions"), files_per_batch)
    return lake.append_stream(stream, TABLE, source="synthetic")


def read_checked_stream(
    spark: SparkSession, folder: str, files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """As `read_mentions_stream`, with the raw line of a bad record, its reason and its file."""
    fields = T.StructType([*MENTIONS.fields, T.StructField(RAW, T.StringType())])
    reader = spark.readStream.schema(fields).option("recursiveFileLookup", "true")
    reader = reader.option("columnNameOfCorruptRecord", RAW).option("mode", "PERMISSIVE")
    rows = reader.option("maxFilesPerTrigger", str(files_per_batch)).json(folder)
    rows = rows.select("*", F.col("_metadata.file_path").alias(FILE))
    nothing = F.coalesce(*(F.col(f).cast("string") for f in MENTIONS.fieldNames())).isNull()
    no_id = F.coalesce(F.col("mention_id") == "", F.lit(True))
    reason = (
        F.when(F.col(RAW).isNotNull() & nothing, "broken")
        .when(no_id, "no id")
        .when(F.col(RAW).isNotNull(), "field")
    )
    whole = F.coalesce(RAW, F.to_json(F.struct(*MENTIONS.fieldNames())))
    return rows.withColumn(REASON, reason).withColumn(RAW, F.when(reason.isNotNull(), whole))


def without_replays(stream: DataFrame, key: str, remembered: str = REMEMBERED) -> DataFrame:
    """The stream without rows whose key has arrived before; rows without key are all kept.

    The state holds one short row for each key that arrived within `remembered`.
    """
    arrived, known = "_arrived", "_key"
    # A row without key gets one that no other has.
    own = F.concat(F.lit("\u0000"), F.expr("uuid()"))
    keyed = stream.withColumn(arrived, F.current_timestamp()).withColumn(known, F.coalesce(F.col(key), own))
    once = keyed.withWatermark(arrived, remembered).dropDuplicatesWithinWatermark([known])
    return once.drop(arrived, known)


def accepted(rows: DataFrame) -> DataFrame:
    kept = rows.where(F.coalesce(F.col(REASON) == "field", F.lit(True)))
    return kept.drop(RAW, REASON, FILE)


def rejected(rows: DataFrame) -> DataFrame:
    noted = rows.where(F.col(REASON).isNotNull())
    return noted.drop(*MENTIONS.fieldNames())


def ingest_checked_mentions(
    lake: Lake, files_per_batch: int = FILES_PER_BATCH, remembered: str = REMEMBERED
) -> dict[str, int]:
    """Appends the mentions landed since the last run, and notes bad records; rows by table.

    Both tables get their rows from the same micro-batch, read once.
    """
    stream = read_checked_stream(lake.spark, lake.landing("mentions"), files_per_batch)
    keyed = stream.withColumn("_id", F.when(F.col("mention_id") != "", F.col("mention_id")))
    once = without_replays(keyed, "_id", remembered).drop("_id")
    routes = {TABLE: accepted, REJECTED: rejected}
    return lake.append_routes(once, routes, "synthetic", f"{TABLE}_checked", STATE_ON_DISK)


def rejects_by_file(rejects: DataFrame) -> DataFrame:
    """Records set aside or noted, by file and reason."""
    return rejects.groupBy(FILE, REASON).agg(F.count("*").alias("num_records"))

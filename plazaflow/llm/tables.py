"""Reading the given tables, and intermediate results that survive lost executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plazaflow.config import scratch_dir

# Schemas of the provided tables; naming them saves a job that reads footers per scan.
SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "benchmark": "item_id bigint, text string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(f"{folder}/{table}.parquet")


def with_text(docs: DataFrame, text_col: str) -> tuple[DataFrame, str]:
    """The rows and the name of a string column with the text: the column itself if it is one."""
    if isinstance(docs.schema[text_col].dataType, T.StringType):
        return docs, text_col
    return docs.withColumn("_text", F.col(text_col).cast("string")), "_text"


def settled(df: DataFrame) -> DataFrame:
    """The same rows, computed now and read back from the shared checkpoint folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_dir(df.sparkSession, "checkpoint"))
    return df.checkpoint(eager=True)

"""A cleaning pipeline over `documents`: five operators of plazaflow.llm, one after the other.

Each stage takes the documents that the one before kept. All but the last return the columns of
documents, so their decisions are rows left out; the last returns the token ids.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plazaflow.llm import bpe, decontaminate, jaccard, language, toxicity
from plazaflow.llm.queries import RANKS, fold
from plazaflow.llm.tables import load, settled

MIN_TOXIC = 0.5
# A text whose likeliest language has a smaller score is a mixture that no language stands out of.
MIN_LANGUAGE = 0.3
# Rows of whole documents that Spark hands to Python at once: a few megabytes of text.
ROWS_AT_ONCE = "1000"


def in_small_batches(stage):
    """The stage, with batches small enough that their copies on both sides stay small too."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_AT_ONCE)
        return stage(spark, docs, sf_dir)

    return run


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = load(spark, sf_dir, "labels").where(fold(F.col("doc_id"), 5) != 0)
    scored = toxicity.scored(docs, toxicity.train(docs, labels), "_toxicity")
    return scored.where(F.col("_toxicity.score") < MIN_TOXIC).drop("_toxicity")


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language.train(docs.where(F.coalesce(fold(F.col("doc_id"), 3) != 1, F.lit(True))))
    found = language.identified(docs, model, "_language")
    known = (F.col("_language.lang") != language.UNKNOWN) & (F.col("_language.score") >= MIN_LANGUAGE)
    return found.where(known).drop("_language")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.deduplicated(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_documents(docs, load(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    pattern = public_tokenizers.PATTERN
    ids = bpe.encode(texts, RANKS, pattern, decoded_col="decoded", keep_tables=False)
    return ids.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        "ids",
        (F.col("decoded") == F.col("text")).alias("round_trip"),
    )


STAGES = [
    ("toxicity", in_small_batches(drop_toxic)),
    ("language ID", in_small_batches(drop_unknown_language)),
    ("n-gram Jaccard join", in_small_batches(drop_near_copies)),
    ("benchmark decontamination", in_small_batches(drop_contaminated)),
    ("byte-level BPE", in_small_batches(encode)),
]

# Scores of trained models and the merges of a tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir))
    return docs

"""Next-hour delay forecast with MLlib: train, judge, keep, serve."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazaflow.operators.features import (
    CATEGORY,
    NUMERIC,
    TARGET,
    TimeSplit,
    scoring_features,
    temporal_split,
)
from plazaflow.sources.lake import Lake

MODEL_NAME = "delay_model"
MIN_TRAINING_ROWS = 50


@dataclass(frozen=True)
class ForestSettings:
    trees: int = 100
    depth: int = 12
    seed: int = 417
    # Training rows are dealt out in parts of about so many, in a fixed order, as the draws of the
    # trees depend on both: the same rows give the same forest on any cluster.
    rows_per_part: int = 10_000

    def parts(self, rows: int) -> int:
        return max(1, -(-rows // self.rows_per_part))


def forecaster(settings: ForestSettings = ForestSettings()) -> Pipeline:
    """Unfitted stages: one column per known line (an unknown line is all zeros) and the forest."""
    return Pipeline(
        stages=[
            StringIndexer(inputCol=CATEGORY, outputCol="line_index", handleInvalid="keep"),
            OneHotEncoder(inputCol="line_index", outputCol="line", dropLast=True),
            VectorAssembler(inputCols=["line", *NUMERIC], outputCol="features"),
            RandomForestRegressor(
                featuresCol="features",
                labelCol=TARGET,
                predictionCol="prediction",
                numTrees=settings.trees,
                maxDepth=settings.depth,
                featureSubsetStrategy="all",
                seed=settings.seed,
            ),
        ]
    )


def errors(actual: str, predicted: str) -> tuple[Column, Column]:
    """Aggregates for the mean absolute and the root mean squared error, in seconds."""
    off = F.col(predicted) - F.col(actual)
    return (
        F.round(F.avg(F.abs(off)), 2).alias("mae_seconds"),
        F.round(F.sqrt(F.avg(off * off)), 2).alias("rmse_seconds"),
    )


def persistence_errors(validation: DataFrame) -> DataFrame:
    """One row: errors of forecasting that the previous slot's delay repeats itself."""
    return validation.agg(*errors(TARGET, "delay_lag_seconds"))


def check_size(split: TimeSplit) -> int:
    """Number of training rows. Training needs enough of them and validation at least one."""
    rows = split.train.count()
    if rows < MIN_TRAINING_ROWS:
        raise RuntimeError(f"{rows} training rows; at least {MIN_TRAINING_ROWS} are needed")
    if split.validation.isEmpty():
        raise RuntimeError("no slot is left for validation")
    return rows


def score_report(model: PipelineModel, split: TimeSplit) -> DataFrame:
    """part, mae_seconds, rmse_seconds, num_rows, first_slot, last_slot."""

    def judged(part: str, df: DataFrame, predicted: str) -> DataFrame:
        return df.agg(
            F.lit(part).alias("part"),
            *errors(TARGET, predicted),
            F.count("*").alias("num_rows"),
            F.count_distinct(CATEGORY).alias("num_lines"),
            F.min("slot_ts").alias("first_slot"),
            F.max("slot_ts").alias("last_slot"),
        )

    return (
        judged("validation", model.transform(split.validation), "prediction")
        .union(judged("baseline", split.validation, "delay_lag_seconds"))
        .union(judged("training", model.transform(split.train), "prediction"))
    )


def train(
    features: DataFrame, settings: ForestSettings = ForestSettings(), train_share: float = 0.8
) -> tuple[PipelineModel, DataFrame]:
    """Fits on the older slots; returns the model and its report against the newer ones."""
    split = temporal_split(features, train_share)
    parts = settings.parts(check_size(split))
    dealt = split.train.repartition(parts, CATEGORY, "slot_ts")
    model = forecaster(settings).fit(dealt.sortWithinPartitions(CATEGORY, "slot_ts"))
    return model, score_report(model, split)


def save_model(lake: Lake, model: PipelineModel, report: DataFrame) -> str:
    """Writes the model and, next to it, its report; returns the model's folder."""
    folder = f"{lake.models}/{MODEL_NAME}"
    model.write().overwrite().save(folder)
    report.withColumn("trained_at", F.current_timestamp()).coalesce(1).write.mode(
        "overwrite"
    ).json(f"{lake.models}/{MODEL_NAME}_metrics")
    return folder


def load_model(lake: Lake) -> PipelineModel:
    """The saved model. A model that is there but cannot be read raises what is wrong with it."""
    folder = f"{lake.models}/{MODEL_NAME}"
    if not lake.has_folder(folder):
        raise RuntimeError(f"no trained model in {folder}; train first")
    return PipelineModel.load(folder)


def predictions(model: PipelineModel, reliability: DataFrame) -> DataFrame:
    """Forecast of each line's next hour."""
    return model.transform(scoring_features(reliability)).select(
        "route_id",
        F.col("slot_ts").alias("predicted_for_ts"),
        "hour_of_day",
        F.col("prediction").alias("predicted_delay_seconds"),
        F.col("delay_lag_seconds").alias("last_observed_delay_seconds"),
        F.current_timestamp().alias("predicted_at"),
        F.lit("real").alias("source"),
    )

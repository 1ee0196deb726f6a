"""Synthetic geolocated mentions for the event day, generated by Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plazaflow.config import METRES_PER_DEGREE, EventConfig
from plazaflow.functions.draws import (
    below,
    digest,
    gauss_pair,
    padded,
    pick,
    pick_weighted,
    pseudonym,
    uniform,
)
from plazaflow.sources.contracts import MENTIONS
from plazaflow.sources.lake import Lake

# Fixed values of the generated data.
PLATFORMS = ("mastodon", "bluesky", "x")
LANGUAGES = ("de", "en", "pl")
SENTIMENT_MEAN, SENTIMENT_SPREAD = 0.35, 0.4
MEDIA_SHARE = 0.4
MENTIONS_PER_TASK = 100_000


def mentions_for(ids: DataFrame, event: EventConfig, number: str = "number") -> DataFrame:
    """One mention per row of `ids`; equal numbers always give equal mentions."""
    digests = {
        name: digest(F.col(number), event.seed, name) for name in ("place", "time", "text")
    }
    # Draws become columns of their own first, so that none is computed more than once.
    drawn = ids.select(F.col(number).alias("n"), *[d.alias(name) for name, d in digests.items()])
    draws = {
        "place": ("stop", "r1", "a1", "platform"),
        "time": ("hour", "minute", "second", "language"),
        "text": ("r2", "a2", "media", "user"),
    }
    drawn = drawn.select(
        "n",
        *[
            uniform(F.col(name), part).alias(draw)
            for name, parts in draws.items()
            for part, draw in enumerate(parts)
        ],
    )

    def at(axis: int) -> Column:
        return pick(F.col("stop"), [point[axis] for point in event.route])

    north, east = gauss_pair(F.col("r1"), F.col("a1"))
    mood, _ = gauss_pair(F.col("r2"), F.col("a2"))
    clock = [
        pick_weighted(F.col("hour"), event.hour_weights),
        below(F.col("minute"), 60),
        below(F.col("second"), 60),
    ]
    sentiment = F.greatest(
        F.lit(-1.0), F.least(F.lit(1.0), SENTIMENT_MEAN + SENTIMENT_SPREAD * mood)
    )
    return drawn.select(
        F.concat(F.lit("men_"), padded(F.col("n"), 6)).alias("mention_id"),
        F.concat(
            F.lit(f"{event.day.isoformat()}T"), F.concat_ws(":", *[padded(c, 2) for c in clock])
        ).alias("event_ts"),
        F.round(at(0) + north * event.jitter_m / METRES_PER_DEGREE, 6).alias("lat"),
        F.round(at(1) + east * event.jitter_m / event.metres_per_degree_lon, 6).alias("lon"),
        pick(F.col("platform"), PLATFORMS).alias("platform"),
        pick(F.col("language"), LANGUAGES).alias("language"),
        F.round(sentiment, 3).alias("sentiment"),
        (F.col("media") < MEDIA_SHARE).alias("has_media"),
        pseudonym(below(F.col("user"), event.num_users), event.salt).alias("user_hash"),
    )


def generate_mentions(
    spark: SparkSession,
    count: int,
    event: EventConfig,
    first: int = 1,
    partitions: int | None = None,
) -> DataFrame:
    """`count` mentions numbered from `first`; batches with disjoint numbers share no id."""
    tasks = partitions or -(-count // MENTIONS_PER_TASK) or 1
    ids = spark.range(first, first + count, 1, tasks).toDF("number")
    return mentions_for(ids, event).select(*MENTIONS.fieldNames())


def land_mentions(lake: Lake, event: EventConfig, batches: int = 5, per_batch: int = 400) -> int:
    """Lands `batches` batches of mentions as JSON lines files; returns the mentions landed.

    A batch has a folder named by the event day and its numbers. One that is there and complete is
    left alone, so a rerun lands nothing twice; one that was cut off is written again.
    """
    landed = 0
    for first in range(1, batches * per_batch + 1, per_batch):
        name = f"{event.compact_day}-{first:012d}-{per_batch}"
        folder = f"{lake.landing('mentions')}/{name}"
        if not lake.has_folder(f"{folder}/_SUCCESS"):
            batch = generate_mentions(lake.spark, per_batch, event, first)
            batch.write.mode("overwrite").json(folder)
            landed += per_batch
    return landed

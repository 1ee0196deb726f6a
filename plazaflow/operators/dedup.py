"""One row per key, chosen by a stated order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_first(
    df: DataFrame,
    keys: Sequence[str],
    largest: Sequence[str] = (),
    smallest: Sequence[str] = (),
    join_side: bool = False,
) -> DataFrame:
    """The row of each key with the largest (then smallest) values; other columns break ties.

    The rank filter becomes a group limit on both sides of the shuffle, so each task sends at most
    one row per key: a key that holds a third of all rows (a replayed feed, features without id)
    arrives as one row per task.

    `join_side` is for a dimension that is joined on its key next. Spark splits a skewed join
    partition only where both join inputs come straight out of a shuffle. Grouping by the key and
    its length groups the same rows but does not count as partitioned by the key, so the
    dimension, not the large side, is shuffled once more below the join.
    """
    ordered = {*keys, *largest, *smallest}
    order = [
        *[F.col(c).desc_nulls_last() for c in largest],
        *[F.col(c).asc_nulls_last() for c in smallest],
        *[F.col(c).desc_nulls_last() for c in df.columns if c not in ordered],
    ]
    spread = [F.length(F.col(k).cast("string")) for k in keys] if join_side else []
    window = Window.partitionBy(*keys, *spread).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def distinct_join_keys(df: DataFrame, key: str) -> DataFrame:
    """Distinct keys for a semi-join, laid out so that a skewed left side can be split."""
    return df.select(key, F.length(F.col(key)).alias("_spread")).distinct().select(key)

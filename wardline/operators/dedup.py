"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], ties: bool = False
) -> DataFrame:
    """First row of each key under `order`, which must be total for a repeatable result; with `ties`
    all rows that come first.

    The rank filter sits right on the window, so Spark plants a group limit below the
    shuffle: every map task sends at most one row per key (and its ties), however hot the key is.
    """
    number = F.rank() if ties else F.row_number()
    rank = number.over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def keep_latest(
    df: DataFrame,
    keys: Sequence[str],
    time: str = "_ingested_at",
    tie_break: Sequence[str] = ("_row_hash",),
    ties: bool = False,
) -> DataFrame:
    """Latest-wins dedup; equal times are settled by `tie_break`, and with `ties` what it leaves equal stays."""
    order = [F.col(time).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tie_break]]
    return first_per_key(df, keys, order, ties)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)

"""Ranks and shares inside a group. Inputs are aggregates, so groups stay small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.functions.numbers import share


def ranked_share(
    df: DataFrame, group: Sequence[str], measure: str, rank_name: str, share_name: str
) -> DataFrame:
    """Dense rank by `measure` (largest first) and its share of the group total."""
    whole = Window.partitionBy(*group)
    return df.withColumns(
        {
            rank_name: F.dense_rank().over(whole.orderBy(F.col(measure).desc())),
            share_name: share(F.col(measure), F.sum(measure).over(whole)),
        }
    )


def top_ranked(df: DataFrame, rank_name: str, most: int) -> DataFrame:
    """Rows whose rank is at most `most`; ties at the edge all stay."""
    return df.filter(F.col(rank_name) <= most)

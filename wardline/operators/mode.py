"""Most frequent value combination per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def most_frequent(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The combination of `values` seen most often for each key; ties take the smallest.

    Counts are combined before the shuffle, so a key with most of the rows costs one row per
    distinct combination and task. NULLs sort first among equal counts.
    """
    counted = df.groupBy(*keys, *values).agg(F.count(F.lit(1)).alias("_n"))
    best = F.struct((-F.col("_n")).alias("_n"), *values)
    return (
        counted.groupBy(*keys)
        .agg(F.min(best).alias("_best"))
        .select(*keys, *[F.col(f"_best.{v}").alias(v) for v in values])
    )

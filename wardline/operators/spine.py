"""Dense grid of places and months."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def month_rows(spark: SparkSession, first_month: str, as_of: dt.date) -> DataFrame:
    """One row per month start from `first_month` to the month of `as_of`."""
    bounds = spark.range(1).select(
        F.to_date(F.lit(f"{first_month}-01")).alias("low"), F.lit(as_of).alias("high")
    )
    return months_between(bounds, F.col("low"), F.col("high"))


def months_between(bounds: DataFrame, low: Column, high: Column) -> DataFrame:
    """Month starts from `low` to `high`; none when `high` comes first."""
    start = F.trunc(low, "MM")
    end = F.trunc(high, "MM")
    steps = F.when(start <= end, F.sequence(start, end, F.expr("INTERVAL 1 MONTH")))
    return bounds.select(F.explode(steps).alias("month_start"))


def zip_month_spine(zips: DataFrame, months: DataFrame) -> DataFrame:
    """Every zip in every month. The months of the date dimension, a few hundred at most, are
    one array value; each zip row unfolds it where it is, so there is no join of all pairs."""
    all_months = months.agg(F.array_sort(F.collect_set("year_month"))).scalar()
    return zips.select("zip_code", "borough", F.explode(all_months).alias("year_month"))

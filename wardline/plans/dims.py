"""Dimension tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline import fixed_values as fv
from wardline.functions import surrogate_key, year_month
from wardline.operators.mode import most_frequent
from wardline.operators.spine import month_rows


def place_rows(staged: Iterable[DataFrame]) -> DataFrame:
    """(zip_code, borough) of every staged row with a known zip."""
    parts = [df.select("zip_code", "borough") for df in staged]
    rows = reduce(DataFrame.unionByName, parts)
    return rows.filter(F.col("zip_code").isNotNull() & (F.col("zip_code") != fv.ZIP_UNKNOWN))


def zip_consensus(staged: Iterable[DataFrame]) -> DataFrame:
    """One row per zip: its most frequent borough, then the first by name. A zip without any
    borough keeps NULL."""
    rows = place_rows(staged)
    known = rows.groupBy("zip_code", "borough").agg(F.count(F.lit(1)).alias("n"))
    order = F.struct(F.col("borough").isNull(), -F.col("n"), "borough")
    return known.groupBy("zip_code").agg(F.min_by("borough", order).alias("borough"))


def dim_zip_codes(seed: DataFrame, staged: Iterable[DataFrame]) -> DataFrame:
    """Seed rows, then zips seen only in the data with their consensus borough."""
    seed = seed.filter(F.col("zip_code").isNotNull()).select(
        "zip_code", "borough", "neighborhood_name", "nta_code"
    )
    extra = zip_consensus(staged).join(seed.select("zip_code"), "zip_code", "left_anti")
    return seed.unionByName(extra, allowMissingColumns=True)


def date_attributes(months: DataFrame, as_of: dt.date | Column) -> DataFrame:
    """Month attributes; current and complete are relative to `as_of`."""
    day = as_of if isinstance(as_of, Column) else F.lit(as_of)
    start = F.col("month_start")
    current = F.trunc(day, "MM")
    return months.select(
        year_month(start).alias("year_month"),
        F.year(start).alias("year"),
        F.month(start).alias("month"),
        F.quarter(start).alias("quarter"),
        F.date_format(start, "MMMM").alias("month_name"),
        (start == current).alias("is_current_month"),
        (start < current).alias("is_complete_month"),
    )


def dim_date(spark: SparkSession, as_of: dt.date, first_month: str = fv.FIRST_MONTH) -> DataFrame:
    return date_attributes(month_rows(spark, first_month, as_of), as_of)


def dim_complaint_types(seed: DataFrame) -> DataFrame:
    return _keyed(seed, "complaint_type", ["category", "subcategory", "responsible_agency"])


def dim_permit_types(seed: DataFrame) -> DataFrame:
    return _keyed(seed, "permit_type", ["permit_type_desc", "job_type", "work_category"])


def _keyed(seed: DataFrame, key: str, others: list[str]) -> DataFrame:
    return seed.filter(F.col(key).isNotNull()).select(
        surrogate_key(F.col(key)).alias(f"{key}_key"), key, *others
    )


def latest_neighborhoods(permits: DataFrame, inspections: DataFrame) -> DataFrame:
    """Per zip the neighbourhood of its newest permit, and its most frequent area code.

    Newest is a maximum, so it is combined before the shuffle like a count."""
    newest = (
        permits.filter(F.col("zip_code").isNotNull() & F.col("neighborhood_name").isNotNull())
        .groupBy("zip_code")
        .agg(
            F.max_by(
                "neighborhood_name", F.struct("issuance_date", "neighborhood_name")
            ).alias("neighborhood_name")
        )
    )
    area = most_frequent(
        inspections.filter(
            F.col("zip_code").isNotNull() & F.col("neighborhood_tabulation_area").isNotNull()
        ),
        ["zip_code"],
        ["neighborhood_tabulation_area"],
    ).withColumnRenamed("neighborhood_tabulation_area", "nta_code")
    return newest.join(area, "zip_code", "full_outer")

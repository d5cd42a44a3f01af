"""Measures per zip and month."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline import fixed_values as fv
from wardline.functions import Months, share
from wardline.operators.joins import full_outer, zero_filled
from wardline.plans.staging import is_active

GRAIN = ("zip_code", "year_month")


def since_month(df: DataFrame, since: str | Months | None) -> DataFrame:
    """Lookback filter: the months from one on, or a set of them; prunes tables laid out by month."""
    if since is None:
        return df
    return df.filter(since.column("year_month") if isinstance(since, Months) else F.col("year_month") >= since)


def _placed(df: DataFrame, since: str | Months | None) -> DataFrame:
    return since_month(
        df.filter(F.col("zip_code").isNotNull() & F.col("year_month").isNotNull()), since
    )


def _mentions(column: str, *words: str) -> Column:
    found = F.lit(False)
    for word in words:
        found = found | F.col(column).like(f"%{word}%")
    return found


def monthly_complaints(staged: DataFrame, since: str | Months | None = None) -> DataFrame:
    return (
        _placed(staged, since)
        .groupBy(*GRAIN)
        .agg(
            F.count(F.lit(1)).alias("total_complaints"),
            F.count_if(_mentions("complaint_type", "Noise")).alias("noise_complaints"),
            F.count_if(_mentions("complaint_type", "Food")).alias("food_complaints"),
            F.count_if(_mentions("complaint_type", "Construction", "Building")).alias(
                "construction_complaints"
            ),
            F.round(F.avg("resolution_time_hours"), 2).alias("avg_resolution_hours"),
            F.count_if(F.col("complaint_status") == "Open").alias("open_complaints"),
            F.count_if(F.col("complaint_status") == "Closed").alias("closed_complaints"),
        )
    )


def monthly_arrests(staged: DataFrame, since: str | Months | None = None) -> DataFrame:
    def of(code: str) -> Column:
        return F.count_if(F.col("law_category") == code)

    return (
        _placed(staged.filter(F.col("zip_code") != fv.ZIP_UNKNOWN), since)
        .groupBy(*GRAIN)
        .agg(
            F.count(F.lit(1)).alias("total_arrests"),
            of("F").alias("felony_count"),
            of("M").alias("misdemeanor_count"),
            of("V").alias("violation_count"),
        )
    )


def monthly_permits(
    staged: DataFrame, since: str | Months | None = None, as_of: dt.date | None = None
) -> DataFrame:
    """With `as_of` the active flag is worked out anew, so rows staged long ago do not go stale."""
    active = (
        F.col("is_active_permit") if as_of is None else is_active(F.col("expiration_date"), as_of)
    )
    return (
        _placed(staged, since)
        .groupBy(*GRAIN)
        .agg(
            F.count(F.lit(1)).alias("total_permits_issued"),
            F.sum(active).alias("active_permits"),
            F.count_if(F.col("job_type") == "NB").alias("new_building_count"),
            F.count_if(F.col("job_type").isin("A1", "A2", "A3")).alias("alteration_count"),
            F.count_if(F.col("job_type") == "DM").alias("demolition_count"),
        )
    )


def monthly_inspections(staged: DataFrame, since: str | Months | None = None) -> DataFrame:
    """Visit measures (score, grade) and violation-row measures from one pass.

    A visit is a restaurant and a day, represented by its lowest violation code and type. The
    rows are first folded to one per visit and zip, combined before the shuffle; the window
    that picks the visit's representative then sees at most one row per zip. A month without
    a representative has only later rows of visits counted elsewhere and drops out.
    """
    first = F.struct("violation_code", "inspection_type", "inspection_score", "inspection_grade")
    folded = (
        _placed(staged, since)
        .groupBy("restaurant_id", "inspection_date", *GRAIN)
        .agg(
            F.min(first).alias("first"),
            F.count_if(F.col("is_critical_violation") == fv.CRITICAL).alias("critical"),
        )
    )
    visit = Window.partitionBy("restaurant_id", "inspection_date").orderBy(
        "first.violation_code", "first.inspection_type", "zip_code"
    )
    leads = F.col("lead")
    grade = F.when(leads, F.col("first.inspection_grade"))

    def graded(letter: str) -> Column:
        return share(F.count_if(grade == letter), F.count(grade))

    return (
        folded.withColumn("lead", F.row_number().over(visit) == 1)
        .groupBy(*GRAIN)
        .agg(
            F.count_if(leads).alias("total_inspections"),
            F.count_distinct(F.when(leads, F.col("restaurant_id"))).alias(
                "unique_restaurants_inspected"
            ),
            F.round(F.avg(F.when(leads, F.col("first.inspection_score"))), 2).alias("avg_score"),
            graded("A").alias("pct_grade_a"),
            graded("B").alias("pct_grade_b"),
            graded("C").alias("pct_grade_c"),
            F.sum("critical").alias("critical_violation_count"),
        )
        .filter(F.col("total_inspections") > 0)
    )


COMPLAINT_COUNTS = (
    "total_complaints",
    "noise_complaints",
    "food_complaints",
    "construction_complaints",
    "open_complaints",
    "closed_complaints",
)
PERMIT_COUNTS = (
    "total_permits_issued",
    "active_permits",
    "new_building_count",
    "alteration_count",
    "demolition_count",
)


def complaints_with_permits(
    complaints: DataFrame, permits: DataFrame, since: str | Months | None = None
) -> DataFrame:
    """Monthly complaints with the permits of the same zip and month, 0 where none."""
    left = since_month(complaints, since)
    right = since_month(permits, since)
    return zero_filled(left.join(right, list(GRAIN), "left"), PERMIT_COUNTS)


def complaints_or_permits(complaints: DataFrame, permits: DataFrame) -> DataFrame:
    """Monthly complaints and permits of all months that have either, 0 where one is missing."""
    return full_outer(complaints, permits, GRAIN, [*COMPLAINT_COUNTS, *PERMIT_COUNTS])

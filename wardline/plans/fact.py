"""Neighbourhood fact: a dense grid with all measures and the composite score."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline import fixed_values as fv
from wardline.operators.joins import left_chain, zero_filled
from wardline.operators.spine import zip_month_spine
from wardline.plans.monthly import GRAIN, since_month

# Fact name of each monthly measure. Counts are zero-filled, averages are not.
COMPLAINT_COLUMNS = {
    "total_complaints": "total_complaints",
    "noise_complaints": "noise_complaint_count",
    "food_complaints": "food_complaint_count",
    "construction_complaints": "construction_complaint_count",
    "avg_resolution_hours": "avg_resolution_hours",
    "open_complaints": "open_complaint_count",
    "closed_complaints": "closed_complaint_count",
}
ARREST_COLUMNS = {
    c: c for c in ("total_arrests", "felony_count", "misdemeanor_count", "violation_count")
}
PERMIT_COLUMNS = {
    "total_permits_issued": "total_permits_issued",
    "active_permits": "active_permit_count",
    "new_building_count": "new_building_count",
    "alteration_count": "alteration_count",
    "demolition_count": "demolition_count",
}
INSPECTION_COLUMNS = {
    "total_inspections": "total_inspections",
    "unique_restaurants_inspected": "unique_restaurants_inspected",
    "avg_score": "avg_inspection_score",
    "pct_grade_a": "pct_grade_a",
    "pct_grade_b": "pct_grade_b",
    "pct_grade_c": "pct_grade_c",
    "critical_violation_count": "critical_violation_count",
}
KEEP_NULL = {
    "avg_resolution_hours",
    "avg_inspection_score",
    "pct_grade_a",
    "pct_grade_b",
    "pct_grade_c",
}


def renamed(monthly: DataFrame, columns: dict[str, str]) -> DataFrame:
    return monthly.select(*GRAIN, *[F.col(old).alias(new) for old, new in columns.items()])


def pulse_score(
    parts=fv.SCORE_PARTS, grade_weight: str = fv.SCORE_GRADE_WEIGHT
) -> Column:
    """Weighted 0-100 score: fewer complaints, arrests and active permits and a larger share of
    A grades raise it. Decimal arithmetic keeps the rounding exact."""
    full = F.lit(Decimal(100))
    grades = F.coalesce(F.col("pct_grade_a").cast("decimal(9,4)"), F.lit(Decimal(0)))
    score = grades * full * F.lit(Decimal(grade_weight))
    for measure, per_point, weight in parts:
        used = F.least(F.col(measure).cast("decimal(20,0)") / F.lit(Decimal(per_point)), full)
        score = score + (full - used) * F.lit(Decimal(weight))
    return F.round(score, 2).cast("double")


def fact_neighborhood_monthly(
    zips: DataFrame,
    dates: DataFrame,
    complaints: DataFrame,
    arrests: DataFrame,
    permits: DataFrame,
    inspections: DataFrame,
    since: str | Months | None = None,
) -> DataFrame:
    """All zips in all months; quiet ones have counts of 0, NULL averages and a score of 70.

    The lookback applies to the dates before the grid is made, and to every measure."""
    grid = zip_month_spine(zips, since_month(dates, since))
    measures = [
        renamed(since_month(df, since), columns)
        for df, columns in (
            (complaints, COMPLAINT_COLUMNS),
            (arrests, ARREST_COLUMNS),
            (permits, PERMIT_COLUMNS),
            (inspections, INSPECTION_COLUMNS),
        )
    ]
    joined = left_chain(grid, measures, GRAIN)
    counts = [
        name
        for columns in (COMPLAINT_COLUMNS, ARREST_COLUMNS, PERMIT_COLUMNS, INSPECTION_COLUMNS)
        for name in columns.values()
        if name not in KEEP_NULL
    ]
    return zero_filled(joined, counts).withColumn("neighborhood_pulse_score", pulse_score())

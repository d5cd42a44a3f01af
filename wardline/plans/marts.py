"""Marts over the fact and the monthly measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions import safe_divide
from wardline.operators.joins import full_outer
from wardline.operators.ranking import ranked_share
from wardline.plans.fact import ARREST_COLUMNS, INSPECTION_COLUMNS, PERMIT_COLUMNS, renamed
from wardline.plans.monthly import GRAIN, since_month


def mart_neighborhood_pulse(
    fact: DataFrame, zips: DataFrame, dates: DataFrame, since: str | Months | None = None
) -> DataFrame:
    """Fact rows with the attributes of their zip and month. Both dimensions are small tables
    on file or small aggregates; Spark broadcasts them by their measured size."""
    places = zips.select("zip_code", "borough", "neighborhood_name", "nta_code")
    return (
        since_month(fact, since)
        .drop("borough")
        .join(places, "zip_code", "left")
        .join(dates, "year_month", "left")
    )


def mart_safety_infrastructure(
    arrests: DataFrame, permits: DataFrame, since: str | Months | None = None
) -> DataFrame:
    left = renamed(since_month(arrests, since), ARREST_COLUMNS)
    right = renamed(since_month(permits, since), PERMIT_COLUMNS)
    counts = [*ARREST_COLUMNS.values(), *PERMIT_COLUMNS.values()]
    return full_outer(left, right, GRAIN, counts).withColumns(
        {
            "arrests_per_permit": safe_divide(
                F.col("total_arrests"), F.col("total_permits_issued"), 2
            ),
            "felony_pct": safe_divide(F.col("felony_count"), F.col("total_arrests"), 4),
        }
    )


def mart_food_compliance(
    inspections: DataFrame, complaints: DataFrame, since: str | Months | None = None
) -> DataFrame:
    left = renamed(since_month(inspections, since), INSPECTION_COLUMNS)
    right = renamed(
        since_month(complaints, since), {"food_complaints": "food_complaint_count"}
    )
    counts = [
        "total_inspections",
        "unique_restaurants_inspected",
        "critical_violation_count",
        "food_complaint_count",
    ]
    return full_outer(left, right, GRAIN, counts).withColumn(
        "food_complaints_per_inspection",
        safe_divide(F.col("food_complaint_count"), F.col("total_inspections"), 4),
    )


def mart_top_complaints(staged: DataFrame, since: str | Months | None = None) -> DataFrame:
    """Complaint types per borough and month with rank and share. The ranking windows run over
    the counts, so a borough-month group holds one row per complaint type."""
    keys = ("borough", "year_month", "complaint_type")
    known = staged
    for key in keys:
        known = known.filter(F.col(key).isNotNull())
    counted = (
        since_month(known, since)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("complaint_count"))
    )
    return ranked_share(
        counted, keys[:2], "complaint_count", "borough_rank", "pct_of_borough_total"
    )

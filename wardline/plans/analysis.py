"""Lag analysis and generation of reference tables from the data."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions import category_of, shift_month, work_category
from wardline.operators import history
from wardline.operators.dedup import first_per_key
from wardline.operators.joins import zero_filled
from wardline.operators.mode import most_frequent
from wardline.plans.dims import latest_neighborhoods, zip_consensus
from wardline.plans.monthly import GRAIN


# Result column -> (source column, months back).
LAG_COLUMNS = {
    "noise_complaints_t": ("noise_complaints", 0),
    "construction_complaints_t": ("construction_complaints", 0),
    "total_complaints_t": ("total_complaints", 0),
    "new_building_count_t": ("new_building_count", 0),
    "new_building_count_t_minus_1": ("new_building_count", 1),
    "total_permits_t_minus_1": ("total_permits_issued", 1),
    "active_permits_t_minus_1": ("active_permits", 1),
    "new_building_count_t_minus_2": ("new_building_count", 2),
    "total_permits_t_minus_2": ("total_permits_issued", 2),
}
LAG_SOURCES = sorted({column for column, _ in LAG_COLUMNS.values()})


def complaint_permit_lag(pairs: DataFrame, grid: DataFrame | None = None) -> DataFrame:
    """Complaints of a month next to the permits of one and two calendar months before.

    Months with complaints or permits are looked at. Without a `grid` they are also all that is
    looked back on, so a month gap leaves NULL. With a `grid` of zips and months each of them is:
    a quiet month counts as 0, and NULL is left only before the grid's first month. `pairs` must
    then hold the months with permits only, too. Each row is sent to its own month and the two
    after it and meets the others in one aggregation: one scan and one shuffle where self-joins
    would take three.
    """
    active = (F.col("total_complaints") > 0) | (F.col("total_permits_issued") > 0)
    if grid is None:
        pairs = pairs.filter(active)
    else:
        pairs = zero_filled(grid.select(*GRAIN).join(pairs, list(GRAIN), "left"), LAG_SOURCES)
    month = F.explode(
        F.array(
            *[
                F.struct(F.lit(k).alias("lag"), shift_month(F.col("year_month"), k).alias("month"))
                for k in (0, 1, 2)
            ]
        )
    )
    spread = pairs.select("zip_code", month.alias("at"), active.alias("active"), *LAG_SOURCES)

    def seen(column: str, lag: int) -> Column:
        return F.max(F.when(F.col("at.lag") == lag, F.col(column)))

    return (
        spread.groupBy("zip_code", F.col("at.month").alias("year_month"))
        .agg(
            F.count_if((F.col("at.lag") == 0) & F.col("active")).alias("present"),
            *[seen(column, lag).alias(name) for name, (column, lag) in LAG_COLUMNS.items()],
        )
        .filter(F.col("present") > 0)
        .drop("present")
    )


def lag_correlation(lags: DataFrame, digits: int = 6) -> DataFrame:
    """Pearson correlation of complaints with lagged new-building permits, over complete pairs."""
    pairs = (
        ("noise_complaints_t", "new_building_count_t_minus_1", "noise_lag_1"),
        ("noise_complaints_t", "new_building_count_t_minus_2", "noise_lag_2"),
        ("construction_complaints_t", "new_building_count_t_minus_1", "construction_lag_1"),
        ("construction_complaints_t", "new_building_count_t_minus_2", "construction_lag_2"),
    )
    return lags.agg(
        *[
            F.round(F.corr(F.col(x).cast("double"), F.col(y).cast("double")), digits).alias(name)
            for x, y, name in pairs
        ]
    )


def zip_seed(
    staged: Iterable[DataFrame], permits: DataFrame, inspections: DataFrame
) -> DataFrame:
    """Zips with a known borough, enriched with neighbourhood and area code."""
    places = zip_consensus(staged).filter(F.col("borough").isNotNull())
    return places.join(latest_neighborhoods(permits, inspections), "zip_code", "left").select(
        "zip_code", "borough", "neighborhood_name", "nta_code"
    )


def complaint_type_seed(complaints: DataFrame, ignore_case: bool = False) -> DataFrame:
    """Each complaint type with its category and most frequent descriptor and agency."""
    typed = most_frequent(
        complaints.filter(F.col("complaint_type").isNotNull()),
        ["complaint_type"],
        ["complaint_descriptor", "responding_agency_code"],
    )
    return typed.select(
        "complaint_type",
        category_of(F.col("complaint_type"), ignore_case).alias("category"),
        F.col("complaint_descriptor").alias("subcategory"),
        F.col("responding_agency_code").alias("responsible_agency"),
    )


def permit_type_seed(permits: DataFrame) -> DataFrame:
    """Each permit type with its most frequent subtype and job type, and the work category."""
    typed = most_frequent(
        permits.filter(F.col("permit_type").isNotNull()),
        ["permit_type"],
        ["permit_subtype", "job_type", "work_type"],
    )
    return typed.select(
        "permit_type",
        F.col("permit_subtype").alias("permit_type_desc"),
        "job_type",
        work_category(F.col("job_type")).alias("work_category"),
    )


RESTAURANT_COLUMNS = (
    "restaurant_id",
    "restaurant_name",
    "cuisine_type",
    "borough",
    "zip_code",
    "inspection_grade",
    "inspection_score",
    "grade_assigned_date",
    "inspection_date",
)
RESTAURANT_CHECKED = (
    "inspection_grade",
    "cuisine_type",
    "restaurant_name",
    "borough",
    "zip_code",
)


def newest_first() -> list[Column]:
    """Newest rows first; equal dates are settled by the record key."""
    return [
        F.col("inspection_date").desc_nulls_last(),
        F.col("grade_assigned_date").desc_nulls_last(),
        F.col("inspection_record_key"),
    ]


def current_restaurants(inspections: DataFrame) -> DataFrame:
    """Newest row per restaurant."""
    rows = inspections.select(*RESTAURANT_COLUMNS, "inspection_record_key")
    return first_per_key(rows, ["restaurant_id"], newest_first()).select(*RESTAURANT_COLUMNS)


def restaurant_history(inspections: DataFrame, runs: Sequence[dt.datetime], gone_days: int) -> DataFrame:
    """The type-2 history that runs at these moments over the newest rows would have made."""
    rows = inspections.select(*RESTAURANT_COLUMNS, "inspection_record_key")
    order = newest_first()
    found = history.replay(rows, "restaurant_id", RESTAURANT_CHECKED, "inspection_date", order, runs, gone_days)
    return found.drop("inspection_record_key")

"""What every stored table must satisfy. An `error` stops the publish, a `warn` is reported."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline import fixed_values as fv
from wardline.operators import quality
from wardline.operators.quality import WARN, Check, accepted_values, not_after, not_null

# Columns that are never NULL, by table.
NOT_NULL = {
    "complaints": ("complaint_id", "created_date", "zip_code"),
    "arrests": ("arrest_id", "arrest_date", "borough", "zip_code"),
    "permits": ("permit_key", "job_number", "permit_sequence_number", "borough", "issuance_date"),
    "inspections": ("inspection_record_key", "restaurant_id", "inspection_date"),
    "monthly_complaints": ("zip_code", "year_month", "total_complaints"),
    "monthly_arrests": ("zip_code", "year_month", "total_arrests"),
    "monthly_permits": ("zip_code", "year_month", "total_permits_issued"),
    "monthly_inspections": ("zip_code", "year_month", "total_inspections"),
    "complaints_with_permits": ("zip_code", "year_month"),
    "zip_codes": ("zip_code", "borough"),
    "complaint_types": ("complaint_type_key", "complaint_type"),
    "permit_types": ("permit_type_key", "permit_type"),
    "dates": ("year_month", "year", "month", "quarter", "month_name", "is_current_month", "is_complete_month"),
    "fact": (
        "zip_code",
        "year_month",
        "borough",
        "total_complaints",
        "total_arrests",
        "total_permits_issued",
        "total_inspections",
        "neighborhood_pulse_score",
    ),
    "pulse": ("zip_code", "year_month", "borough", "neighborhood_pulse_score"),
    "safety": ("zip_code", "year_month"),
    "food": ("zip_code", "year_month"),
    "top_types": ("borough", "year_month", "complaint_type", "borough_rank"),
}
# Unique keys, each on its own.
UNIQUE = {
    "complaints": (("complaint_id",),),
    "arrests": (("arrest_id",),),
    "permits": (("permit_key",),),
    "inspections": (("inspection_record_key",),),
    "zip_codes": (("zip_code",),),
    "complaint_types": (("complaint_type_key",), ("complaint_type",)),
    "permit_types": (("permit_type_key",), ("permit_type",)),
    "dates": (("year_month",),),
    "fact": (("zip_code", "year_month"),),
}


def row_checks(table: str, as_of: dt.date) -> list[Check]:
    checks = [not_null(c) for c in NOT_NULL[table]]
    raw = F.trim("borough_raw")
    if table == "complaints":
        checks += [
            not_null("borough", where=raw.isNotNull() & ~raw.isin("", "Unspecified")),
            accepted_values("complaint_status", [*fv.STATUS_CODES, fv.STATUS_DEFAULT]),
            not_after("created_date", as_of),
        ]
    elif table == "arrests":
        checks += [
            accepted_values("law_category", fv.LAW_CATEGORIES),
            accepted_values("zip_code_source", [fv.ZIP_FROM_POLYGON, fv.ZIP_FALLBACK]),
            not_after("arrest_date", as_of),
        ]
    elif table == "permits":
        checks += [not_null("zip_code", WARN), not_after("issuance_date", as_of)]
    elif table == "inspections":
        checks += [
            not_null("zip_code", WARN),
            not_null("borough", where=F.col("borough_raw") != "0"),
            accepted_values("is_critical_violation", fv.CRITICAL_FLAGS),
            accepted_values("inspection_grade", fv.GRADE_VALUES),
            not_after("inspection_date", as_of),
        ]
    elif table == "fact":
        checks.append(quality.in_range("neighborhood_pulse_score", 0, 100))
    return checks


def check_tables(tables: Mapping[str, DataFrame], as_of: dt.date) -> DataFrame:
    """One row per check of the given tables: row checks in one pass over each, keys, references."""
    parts = [quality.run_checks(df, name, row_checks(name, as_of)) for name, df in tables.items()]
    parts += [
        quality.unique_check(df, name, keys)
        for name, df in tables.items()
        for keys in UNIQUE.get(name, ())
    ]
    if "fact" in tables:
        for parent, key in (("zip_codes", "zip_code"), ("dates", "year_month")):
            if parent in tables:
                parts.append(quality.relationship_check(tables["fact"], "fact", tables[parent], {key: key}))
    return reduce(DataFrame.unionByName, parts)

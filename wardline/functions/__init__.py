"""Column-level functions; all of them build Catalyst expressions, none is a UDF."""

from wardline.functions.codes import (
    category_of,
    code_lookup,
    grade_number,
    law_category,
    normalize_grade,
    normalize_status,
    standardize_borough,
    tier,
    work_category,
)
from wardline.functions.dates import Months, hours_between, lookback_floor, shift_month, year_month
from wardline.functions.keys import row_hash, surrogate_key, with_gold_audit, with_staging_audit
from wardline.functions.numbers import clamp_score, log_scaled, safe_divide, share
from wardline.functions.text import blank_to_null, clean_text, tolerant

__all__ = [
    "Months",
    "blank_to_null",
    "category_of",
    "clamp_score",
    "clean_text",
    "code_lookup",
    "grade_number",
    "hours_between",
    "law_category",
    "log_scaled",
    "lookback_floor",
    "normalize_grade",
    "normalize_status",
    "row_hash",
    "safe_divide",
    "share",
    "shift_month",
    "standardize_borough",
    "surrogate_key",
    "tier",
    "tolerant",
    "with_gold_audit",
    "with_staging_audit",
    "work_category",
    "year_month",
]

"""Arithmetic with the NULL and rounding rules of the marts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_divide(top: Column, bottom: Column, digits: int | None = None) -> Column:
    """Double division; NULL when the denominator is zero or NULL."""
    ratio = F.try_divide(top.cast("double"), bottom.cast("double"))
    return ratio if digits is None else F.round(ratio, digits)


def share(part: Column, whole: Column, digits: int = 4) -> Column:
    """Part of whole as a fraction of 1."""
    return safe_divide(part, whole, digits)


def log_scaled(count: Column, digits: int = 4) -> Column:
    return F.round(F.log10(count + F.lit(1)), digits)


def clamp_score(value: Column, inverted: bool = False) -> Column:
    """Limit to 0-100; `inverted` makes fewer better."""
    capped = F.least(F.coalesce(value.cast("double"), F.lit(0.0)), F.lit(100.0))
    return F.greatest(F.lit(0.0), F.lit(100.0) - capped) if inverted else capped

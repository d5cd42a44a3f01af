"""Code standardisation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardline import fixed_values as fv
from wardline.functions.text import clean_text


def code_lookup(
    raw: Column, codes: Mapping[object, Iterable[str]], default: object = None
) -> Column:
    """Value whose code list holds the trimmed upper-case text, else `default`."""
    text = F.upper(F.trim(raw.cast("string")))
    found = F.when(F.lit(False), F.lit(None))
    for value, accepted in codes.items():
        found = found.when(text.isin(*accepted), F.lit(value))
    return found.otherwise(F.lit(default))


def standardize_borough(raw: Column) -> Column:
    return code_lookup(raw, fv.BOROUGH_CODES)


def normalize_status(raw: Column) -> Column:
    return code_lookup(raw, fv.STATUS_CODES, fv.STATUS_DEFAULT)


def law_category(raw: Column) -> Column:
    return clean_text(F.upper(raw), fv.BLANK_TOKENS)


def normalize_grade(raw: Column) -> Column:
    return clean_text(F.upper(raw), fv.BLANK_TOKENS)


def grade_number(raw: Column) -> Column:
    return code_lookup(raw, {n: (g,) for g, n in fv.GRADE_NUMBERS.items()}).cast("int")


def work_category(job_type: Column) -> Column:
    found = F.when(F.lit(False), F.lit(None))
    for label, codes in fv.WORK_CATEGORIES.items():
        found = found.when(job_type.isin(*codes), label)
    return found.otherwise(fv.WORK_DEFAULT)


def category_of(complaint_type: Column, ignore_case: bool = False) -> Column:
    """First category with a word contained in the complaint type."""
    text = F.lower(complaint_type) if ignore_case else complaint_type
    found = F.when(F.lit(False), F.lit(None))
    for label, words in fv.CATEGORY_RULES:
        hit = F.lit(False)
        for word in words:
            hit = hit | text.contains(word.lower() if ignore_case else word)
        found = found.when(hit, label)
    return found.otherwise(fv.CATEGORY_DEFAULT)


def tier(score: Column, bounds: Iterable[tuple[int, str]] = fv.HEALTH_TIERS) -> Column:
    found = F.when(score.isNull(), fv.TIER_MISSING)
    for low, label in bounds:
        found = found.when(score >= low, label)
    return found.otherwise(fv.TIER_DEFAULT)

"""Cleaning of raw string columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardline.fixed_values import STRICT_TOKENS


def clean_text(raw: Column, tokens: Iterable[str] = ()) -> Column:
    """Trimmed text; values equal to one of `tokens` (any case) become NULL."""
    trimmed = F.trim(raw)
    return blank_to_null(trimmed, tokens) if tokens else trimmed


def blank_to_null(text: Column, tokens: Iterable[str] = STRICT_TOKENS) -> Column:
    return F.when(~F.upper(F.trim(text)).isin(*tokens), text)


def tolerant(raw: Column, kind: str) -> Column:
    """Cast that yields NULL on bad text. A double that parses to NaN is treated as missing."""
    value = raw.try_cast(kind)
    return F.when(~F.isnan(value), value) if kind == "double" else value

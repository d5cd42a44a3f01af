"""Month strings and date rules. Months are 'yyyy-MM', so text order is time order."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def year_month(when: Column) -> Column:
    return F.date_format(when, "yyyy-MM")


@dataclass(frozen=True)
class Months:
    """The months from `since` on, and some before it."""

    since: str
    also: frozenset[str] = frozenset()

    def hold(self, month: str | None) -> bool:
        return month is not None and (month >= self.since or month in self.also)

    def column(self, name: str) -> Column:
        late = F.col(name) >= self.since
        early = sorted(m for m in self.also if m < self.since)
        return late | F.col(name).isin(early) if early else late


def lookback_floor(as_of: dt.date, days: int) -> str:
    """First month a run with this lookback recomputes; a plain string, so scans can prune."""
    return (as_of - dt.timedelta(days=days)).strftime("%Y-%m")


def shift_month(month: Column, months: int) -> Column:
    return year_month(F.add_months(F.to_date(F.concat(month, F.lit("-01"))), months))


def hours_between(start: Column, end: Column) -> Column:
    """Whole hours, truncated toward zero; negative when `end` is earlier."""
    return F.timestamp_diff("HOUR", start, end)

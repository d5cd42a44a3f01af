"""Data-quality checks. Each yields one row: check, severity, failures."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.context import utc

from wardline.operators.dedup import duplicate_keys
from wardline.operators.joins import orphan_rows

ERROR = "error"
WARN = "warn"
LAYOUT = ("check_name", "severity", "failures")


class Check:
    """A named row test: rows for which `bad` is true are failures (NULL is not a failure)."""

    def __init__(self, name: str, bad: Column, severity: str = ERROR, where: Column | None = None):
        self.name = name
        self.severity = severity
        self.bad = bad if where is None else where & bad


def not_null(column: str, severity: str = ERROR, where: Column | None = None) -> Check:
    return Check(f"not_null:{column}", F.col(column).isNull(), severity, where)


def accepted_values(
    column: str, values: Iterable[object], severity: str = ERROR, where: Column | None = None
) -> Check:
    return Check(f"accepted_values:{column}", ~F.col(column).isin(*values), severity, where)


def in_range(column: str, low: float, high: float, severity: str = ERROR) -> Check:
    return Check(
        f"in_range:{column}", (F.col(column) < low) | (F.col(column) > high), severity
    )


def not_after(column: str, as_of: dt.date, severity: str = ERROR) -> Check:
    return Check(f"not_after:{column}", F.to_date(column) > F.lit(as_of), severity)


def run_checks(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """All row tests of one table in a single pass over it."""
    counts = [F.count_if(c.bad).alias(f"c{i}") for i, c in enumerate(checks)]
    rows = F.array(
        *[
            F.struct(
                F.lit(f"{table}.{c.name}").alias("check_name"),
                F.lit(c.severity).alias("severity"),
                F.col(f"c{i}").alias("failures"),
            )
            for i, c in enumerate(checks)
        ]
    )
    return df.agg(*counts).select(F.explode(rows).alias("r")).select("r.*")


def unique_check(
    df: DataFrame, table: str, keys: Sequence[str], severity: str = ERROR
) -> DataFrame:
    narrow = df.select(*_packed(df, keys))
    return _one_row(duplicate_keys(narrow, narrow.columns), f"{table}.unique:{','.join(keys)}", severity)


def relationship_check(
    child: DataFrame,
    table: str,
    parent: DataFrame,
    columns: Mapping[str, str],
    severity: str = ERROR,
) -> DataFrame:
    return _one_row(
        orphan_rows(child, parent, columns), f"{table}.relationship:{','.join(columns)}", severity
    )


def future_rows(
    sources: Mapping[str, tuple[DataFrame, str, str]], as_of: dt.date | Column
) -> DataFrame:
    """Rows dated after `as_of` over several sources (name -> frame, id column, date column).
    Ids are text, since the sources key their rows by different types."""
    limit = as_of if isinstance(as_of, Column) else F.lit(as_of)
    parts = [
        df.filter(F.to_date(date) > limit).select(
            F.lit(name).alias("source"),
            F.col(key).cast("string").alias("record_id"),
            F.to_date(date).alias("record_date"),
        )
        for name, (df, key, date) in sources.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def freshness(
    df: DataFrame,
    source: str,
    as_of: dt.datetime | Column,
    warn_hours: int,
    error_hours: int,
    column: str = "_ingested_at",
) -> DataFrame:
    """One row: the newest load, its age in whole hours, and PASS, WARN or ERROR by exact times."""
    now = utc(as_of)
    age = F.timestamp_diff("HOUR", F.col("newest"), now)

    def older(hours: int) -> Column:
        return F.timestamp_add("HOUR", F.lit(hours), F.col("newest"))

    status = (
        F.when(F.col("newest").isNull() | (now > older(error_hours)), "ERROR")
        .when(now > older(warn_hours), "WARN")
        .otherwise("PASS")
    )
    return df.agg(F.max(column).cast("timestamp").alias("newest")).select(
        F.lit(source).alias("source"), "newest", age.alias("age_hours"), status.alias("status")
    )


def newest_day(df: DataFrame, day: str = "_ingest_date") -> DataFrame:
    """The rows of the newest day of a table laid out by ingest day, where the newest load lies.

    The day itself is a partition value: finding it opens no column, and what follows reads one
    day's files. Rows without a day are kept.
    """
    newest = df.agg(F.max(day)).first()[0]
    return df if newest is None else df.filter(F.col(day).isNull() | (F.col(day) >= newest))


def freshness_checks(status: DataFrame) -> DataFrame:
    """Freshness rows as checks: ERROR stops a publish, WARN is reported."""
    severity = F.when(F.col("status") == "WARN", WARN).otherwise(ERROR)
    return status.select(
        F.concat(F.lit("freshness:"), "source").alias("check_name"),
        severity.alias("severity"),
        (F.col("status") != "PASS").cast("long").alias("failures"),
    )


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row count and NULL count of each column, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )


def enforce(results: DataFrame) -> list[str]:
    """Raise when an `error` check failed; return the names of failed `warn` checks.
    The result table has one row per check, so it may be collected."""
    failed = results.filter(F.col("failures") > 0).collect()
    errors = [f"{r.check_name}: {r.failures}" for r in failed if r.severity == ERROR]
    if errors:
        raise ValueError("data-quality checks failed: " + "; ".join(sorted(errors)))
    return sorted(r.check_name for r in failed if r.severity == WARN)


def _packed(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """Columns that are alike where the keys are. An MD5 as text goes through the shuffle as its 16
    bytes, half of what the digits take; any other text stays as it is, in a column of its own."""
    columns = []
    for i, key in enumerate(keys):
        value = F.col(key)
        if df.select(value).schema[0].dataType.simpleString() == "string":
            raw = F.unhex(value)
            is_md5 = F.coalesce((F.octet_length(value) == 32) & (F.lower(F.hex(raw)) == value), F.lit(False))
            columns.append(F.when(is_md5, raw).alias(f"_md5_{i}"))
            value = F.when(~is_md5, value)
        columns.append(value.alias(f"_key_{i}"))
    return columns


def _one_row(failing: DataFrame, name: str, severity: str) -> DataFrame:
    return failing.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(name).alias("check_name"), F.lit(severity).alias("severity"), "failures"
    )

"""Keyset extraction of new source rows, page by page, with a resumable cursor."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.context import RunContext
from wardline.fixed_values import EXTRACT_SOURCES
from wardline.sources import files


@dataclass(frozen=True)
class Cursor:
    """Position in the order (date, key...): everything after it is new."""

    date: str
    key: tuple[str, ...] | None = None

    def to_text(self) -> str:
        return json.dumps({"date": self.date, "pk": list(self.key) if self.key else None})


def first_watermark(source: str, ctx: RunContext) -> str:
    configured = EXTRACT_SOURCES[source][2]
    return configured or f"{ctx.as_of.year}-01-01T00:00:00.000"


def parse_cursor(text: str | None, default_date: str) -> Cursor:
    """Stored cursor: JSON, or a plain date from before keys were kept."""
    if not isinstance(text, str):
        return Cursor(default_date)
    text = text.strip()
    try:
        stored = json.loads(text)
    except json.JSONDecodeError:
        return Cursor(text)
    if not isinstance(stored, dict) or "date" not in stored:
        return Cursor(text)
    key = stored.get("pk")
    if key is not None and not isinstance(key, list):
        key = [key]
    return Cursor(stored["date"], tuple(str(k) for k in key) if key else None)


def after_cursor(columns: Sequence[str], values: Sequence[object]) -> Column:
    """Rows past `values` in the lexicographic order of `columns`."""
    past = F.lit(False)
    tied = F.lit(True)
    for name, value in zip(columns, values):
        past = past | (tied & (F.col(name) > F.lit(value)))
        tied = tied & (F.col(name) == F.lit(value))
    return past


def keyset_page(
    df: DataFrame, date: str, keys: Sequence[str], cursor: Cursor, rows: int
) -> DataFrame:
    """The next `rows` rows in cursor order. The leading date bound reaches the scan."""
    return past_cursor(df, date, keys, cursor).orderBy(date, *keys).limit(rows)


def past_cursor(df: DataFrame, date: str, keys: Sequence[str], cursor: Cursor) -> DataFrame:
    """Every row past the cursor, unordered. Rows of the cursor's date without a key are kept, so
    that a check can see them."""
    if cursor.key is None:
        return df.filter(F.col(date) > F.lit(cursor.date))
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    new = df.filter(F.col(date) >= F.lit(cursor.date))
    return new.filter(after_cursor([date, *keys], [cursor.date, *cursor.key]) | no_key)


def all_strings(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def extract_new_rows(
    spark: SparkSession,
    df: DataFrame,
    source: str,
    landing: str,
    state_path: str,
    ctx: RunContext,
    page_rows: int | None = None,
    lookback_days: int = 0,
) -> int:
    """Land the rows of `df` past the cursor as an all-string parquet folder; returns their number.

    All of them are written in parallel and the cursor is the largest (date, key...) among them,
    compared by their types. With `page_rows` only the next so many rows in cursor order are
    taken, for sources that must be read in pages. `lookback_days` moves the cursor back first,
    to fetch rows changed after they were read.

    Rows are checked in a folder beside the landing zone and moved in only when every one has its
    cursor and key values, so a refused run leaves nothing to ingest. The cursor is stored last
    and the folder is named by the run, so a lost run is simply repeated.
    """
    date, keys, _ = EXTRACT_SOURCES[source]
    cursor = parse_cursor(files.read_text(spark, state_path), first_watermark(source, ctx))
    if lookback_days:
        cursor = lookback_cursor(cursor, lookback_days)
    new = past_cursor(df, date, keys, cursor)
    if page_rows is not None:
        new = new.orderBy(date, *keys).limit(page_rows)
    side, path = f"{landing}.refused/run={ctx.run_id}", f"{landing}/run={ctx.run_id}"
    all_strings(new).write.mode("overwrite").parquet(side)
    written = spark.read.parquet(side)
    # Texts are compared as what they were, so that 10 comes after 9.
    typed = [F.col(c).cast(df.schema[c].dataType).alias(c) for c in (date, *keys)]
    missing = F.count_if(F.greatest(*[F.col(c).isNull() for c in (date, *keys)]))
    last = F.max(F.struct(*typed, *[F.col(c).alias(f"_{c}") for c in (date, *keys)]))
    rows, bad, newest = written.agg(F.count(F.lit(1)), missing, last).first()
    if bad:
        raise ValueError(f"{bad} rows of {source} lack a cursor or key value; cursor not moved")
    files.delete(spark, path)
    files.rename(spark, side, path)
    if rows:
        advanced = Cursor(newest[f"_{date}"], tuple(newest[f"_{k}"] for k in keys))
        files.write_text(spark, state_path, advanced.to_text())
    return rows


def lookback_cursor(cursor: Cursor, days: int) -> Cursor:
    """Cursor moved back, to fetch rows changed after they were first read."""
    moment = dt.datetime.fromisoformat(cursor.date) - dt.timedelta(days=days)
    return Cursor(moment.isoformat(timespec="milliseconds"))

"""Run context and session defaults. Nothing else in the package reads the clock."""

from __future__ import annotations

import datetime as dt
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def utc(moment: dt.datetime | Column) -> Column:
    """A moment as a timestamp column. Naive times are UTC, whatever zone the driver runs in."""
    if isinstance(moment, Column):
        return moment.cast("timestamp")
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=dt.timezone.utc)
    return F.lit(moment).cast("timestamp")


@dataclass(frozen=True)
class RunContext:
    """Clock, run id and provenance of one run; every date rule takes `as_of` from here."""

    as_of: dt.date = field(default_factory=lambda: _now().date())
    run_ts: dt.datetime = field(default_factory=_now)
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    job_path: str = "wardline"
    source_system: str = "OPEN_DATA"


# Settings a job wants on a cluster as well as on a laptop. Shuffle partitions are left to
# AQE coalescing from a high start; the caller's cluster defaults win where already set.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(
    app: str = "wardline",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **settings: str,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SESSION_DEFAULTS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Temporary folders by application: a running session's spark.checkpoint.dir cannot be set.
_made: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder for cut lineage; a temporary one only on a single machine."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError(f"spark.checkpoint.dir names no shared folder, and {master} has executors of its own")
    application = spark.sparkContext.applicationId
    if application not in _made:
        _made[application] = tempfile.mkdtemp(prefix="wardline-")
    return _made[application]


MAX_SPLIT = "spark.sql.files.maxPartitionBytes"
#: Bytes of a file that one task reads while its rows are sorted before a shuffle: some two to three
#: million narrow rows, which a task of a 10 GB executor with 4 cores sorts in memory.
SORTED_SPLIT_BYTES = 32 * 1024 * 1024
_UNITS = {"": 0, "b": 0, "k": 10, "kb": 10, "m": 20, "mb": 20, "g": 30, "gb": 30, "t": 40, "tb": 40}


def _bytes(size: str) -> int:
    number, unit = re.fullmatch(r"(\d+)([a-z]*)", size.strip().lower()).groups()
    return int(number) << _UNITS[unit]


@contextmanager
def split_limit(spark: SparkSession, limit: int = SORTED_SPLIT_BYTES) -> Iterator[None]:
    """What runs within reads at most `limit` bytes of a file per task, less where the session says so.

    Tasks that sort what they read then hold as much of a small table as of a large one: with more
    input there are more of them. The session's own setting is back in place afterwards.
    """
    before = spark.conf.get(MAX_SPLIT)
    spark.conf.set(MAX_SPLIT, f"{min(limit, _bytes(before))}b")
    try:
        yield
    finally:
        spark.conf.set(MAX_SPLIT, before)

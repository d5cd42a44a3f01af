"""Type-2 history: one row per key and validity interval, run by run or replayed at once."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline.context import utc
from wardline.sources.versions import Version, VersionedTable, values_of

VALID_FROM = "valid_from"
VALID_TO = "valid_to"


def start_history(current: DataFrame, run_ts: dt.datetime | Column) -> DataFrame:
    """History after the first run: every row open since `run_ts`."""
    return current.select(
        "*",
        utc(run_ts).alias(VALID_FROM),
        F.lit(None).cast("timestamp").alias(VALID_TO),
    )


def apply_snapshot(
    history: DataFrame,
    current: DataFrame,
    key: str,
    check: Sequence[str],
    run_ts: dt.datetime | Column,
) -> DataFrame:
    """History after one more run.

    A change in any `check` column closes the open row and opens a new one; a key missing
    from `current` is closed; a key that comes back opens a new row. Other columns are taken
    over only when a row opens. One shuffle: the open rows meet the current rows once and
    each pair yields its one or two result rows; closed rows pass through untouched.
    """
    layout = [*current.columns, VALID_FROM, VALID_TO]
    closed = history.filter(F.col(VALID_TO).isNotNull()).select(*layout)
    opened = history.filter(F.col(VALID_TO).isNull())
    return meet_snapshot(opened, current, key, check, run_ts).unionByName(closed)


def meet_snapshot(
    opened: DataFrame, current: DataFrame, key: str, check: Sequence[str], run_ts: dt.datetime | Column
) -> DataFrame:
    """What one more run makes of the open rows: rows still open, newly open and just closed."""
    columns = current.columns
    layout = [*columns, VALID_FROM, VALID_TO]
    moment = utc(run_ts)
    before = opened.select(F.col(key).alias("_key"), F.struct(*layout).alias("_old"))
    after = current.select(F.col(key).alias("_key"), F.struct(*columns).alias("_new"))
    pairs = before.join(after, "_key", "full_outer")

    never = F.lit(None).cast("timestamp")
    old_row = F.struct(*[F.col(f"_old.{c}").alias(c) for c in layout])
    old_closed = F.struct(
        *[F.col(f"_old.{c}").alias(c) for c in [*columns, VALID_FROM]], moment.alias(VALID_TO)
    )
    new_row = F.struct(
        *[F.col(f"_new.{c}").alias(c) for c in columns],
        moment.alias(VALID_FROM),
        never.alias(VALID_TO),
    )
    same = F.lit(True)
    for c in check:
        same = same & F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}"))
    outcome = (
        F.when(F.col("_old").isNull(), F.array(new_row))
        .when(F.col("_new").isNull(), F.array(old_closed))
        .when(same, F.array(old_row))
        .otherwise(F.array(old_closed, new_row))
    )
    return pairs.select(F.explode(outcome).alias("_row")).select("_row.*")


PART = "part"
OPEN, CLOSED = "open", "closed"
#: So many folders of closed rows of one tier become one of the next.
FAN = 8


def history_table(spark: SparkSession, root: str) -> VersionedTable:
    return VersionedTable(spark, root, (PART,))


def add_run(
    spark: SparkSession, root: str, current: DataFrame, key: str, check: Sequence[str], run_ts: dt.datetime, run_id: str = ""
) -> Version:
    """Add a run to the stored history at `root`: only open rows are read and written.

    Closed rows are appended. Of every `FAN` folders of them one is made, and of every `FAN` such
    folders again, so folders grow with the logarithm of the runs and a closed row is written
    again once per tier. Else a run's cost follows the open rows, however long the history is.
    Runs go forward in time. A run repeated under its id changes nothing.
    """
    table = history_table(spark, root)
    before, number = table.next_number()
    if before is None:
        rows = start_history(current, run_ts)
    elif run_id and before.facts["run_id"] == run_id:
        return before
    elif run_ts <= dt.datetime.fromisoformat(before.facts["run_ts"]):
        raise ValueError(f"run of {run_ts} is not later than the last, {before.facts['run_ts']}")
    else:
        opened = table.read(before, lambda v: v[PART] == OPEN).drop(PART)
        rows = meet_snapshot(opened, current, key, check, run_ts)
    rows = rows.withColumn(PART, F.when(F.col(VALID_TO).isNull(), OPEN).otherwise(CLOSED))
    kept = [f for f in before.folders if values_of(f)[PART] == CLOSED] if before else []
    tiers = {f: before.facts.get("tiers", {}).get(f, 0) for f in kept}
    merged, tier = _due(tiers)
    if merged:
        numbers = {values_of(f)["_v"] for f in merged}
        old = table.read(before, lambda v: v[PART] == CLOSED and v["_v"] in numbers)
        rows = rows.unionByName(old.select(*rows.columns))
    folders = table.write(rows, number)
    tiers = {f: t for f, t in tiers.items() if f not in merged}
    tiers |= {f: tier for f in folders if values_of(f)[PART] == CLOSED}
    kept = [f for f in kept if f not in merged]
    return table.commit(
        before, [*kept, *folders], rows.schema, run_ts=run_ts.isoformat(), run_id=run_id, tiers=tiers
    )


def _due(tiers: dict[str, int]) -> tuple[list[str], int]:
    """The folders of closed rows that the next run's join, and the tier of the folder they make."""
    merged, tier = [], 0
    while len(same := [f for f, t in tiers.items() if t == tier]) >= FAN - 1:
        merged += same
        tier += 1
    return merged, tier


def read_history(spark: SparkSession, root: str) -> DataFrame:
    """All intervals of the stored history."""
    return history_table(spark, root).read().drop(PART)


def replay(
    rows: DataFrame, key: str, check: Sequence[str], day: str, newest: Sequence[Column], runs: Sequence[dt.datetime], gone_days: int
) -> DataFrame:
    """The history that runs at these moments would have made, from dated rows in one pass.

    A run's snapshot is the newest row per key up to its day, unless that is older than
    `gone_days`. Rows are cut down to the newest per key between two runs before the shuffle's
    result is kept, so a key holds no more rows than there are runs; its intervals are then
    worked out within the row.
    """
    columns = rows.columns
    runs = sorted(runs)
    days = F.array(*[F.lit(r.date()) for r in runs])
    turn = F.size(F.filter(days, lambda d: d < F.col(day)))
    dated = rows.withColumn("_turn", turn).filter((F.col("_turn") < len(runs)) & F.col(day).isNotNull())
    order = Window.partitionBy(key, "_turn").orderBy(*newest)
    firsts = dated.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1")
    held = firsts.groupBy(key).agg(F.collect_list(F.struct("_turn", F.struct(*columns).alias("row"))).alias("held"))

    def state(i: int, moment: dt.datetime) -> Column:
        known = F.filter("held", lambda h: h["_turn"] <= i)
        last = F.array_max(F.transform(known, lambda h: h["_turn"]))
        row = F.get(F.filter(known, lambda h: h["_turn"] == last), F.lit(0))["row"]
        since = F.lit(moment.date() - dt.timedelta(days=gone_days))
        return F.when(row[day] >= since, row)

    states = held.select(F.array(*[state(i, r) for i, r in enumerate(runs)]).alias("s"))
    changed = []
    for i in range(len(runs)):
        now = F.col("s")[i]
        if not i:
            changed.append(now.isNotNull())
            continue
        before = F.col("s")[i - 1]
        same = now.isNotNull() & before.isNotNull()
        for c in check:
            same = same & now[c].eqNullSafe(before[c])
        changed.append(~same & (now.isNotNull() | before.isNotNull()))
    moments = [utc(r) for r in runs]
    intervals = []
    for i in range(len(runs)):
        end = F.coalesce(*[F.when(changed[j], moments[j]) for j in range(i + 1, len(runs))], F.lit(None).cast("timestamp"))
        opens = changed[i] & F.col("s")[i].isNotNull()
        intervals.append(F.when(opens, F.struct(F.col("s")[i].alias("row"), moments[i].alias(VALID_FROM), end.alias(VALID_TO))))
    found = states.select(F.explode(F.array_compact(F.array(*intervals))).alias("_i"))
    return found.select("_i.row.*", f"_i.{VALID_FROM}", f"_i.{VALID_TO}")


def as_of(history: DataFrame, moment: dt.datetime | Column) -> DataFrame:
    """The rows valid at `moment`."""
    at = utc(moment)
    return history.filter(
        (F.col(VALID_FROM) <= at) & (F.col(VALID_TO).isNull() | (F.col(VALID_TO) > at))
    )


def transitions(
    history: DataFrame,
    key: str,
    column: str,
    then: dt.datetime | Column,
    now: dt.datetime | Column,
) -> DataFrame:
    """Keys per (value then, value now), for keys valid at both moments."""
    old = as_of(history, then).select(key, F.col(column).alias(f"{column}_then"))
    new = as_of(history, now).select(key, F.col(column).alias(f"{column}_now"))
    return (
        old.join(new, key)
        .groupBy(f"{column}_then", f"{column}_now")
        .agg(F.count(F.lit(1)).alias("keys"))
    )

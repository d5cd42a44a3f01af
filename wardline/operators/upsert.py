"""Keyed upsert and month replacement, as DataFrames and onto stored versions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.functions.dates import Months
from wardline.sources import files
from wardline.sources.versions import Version, VersionedTable, values_of

MONTH, BUCKET = "year_month", "bucket"
#: Buckets of a keyed table. A month's rows are cut into so many, so pick a number that keeps one
#: of a large month within a few hundred MB; it is fixed when the table is first written.
BUCKETS = 16


def merge_rows(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Updates replace target rows of the same key, other updates are added.

    `updates` must hold one row per key. NULL keys match nothing, as in SQL MERGE. Columns
    only one side has are NULL on the other.
    """
    kept = target.join(updates.select(*keys), list(keys), "left_anti")
    return kept.unionByName(updates, allowMissingColumns=True)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a key, by its text, so that it does not depend on the key's type."""
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


def keyed_table(spark: SparkSession, root: str) -> VersionedTable:
    """A table laid out by month and, within it, by bucket of the key."""
    return VersionedTable(spark, root, (MONTH, BUCKET))


def merged_schema(known: T.StructType, seen: T.StructType) -> T.StructType:
    """Columns are added, never dropped; one that changes its type is refused."""
    held = {f.name: f for f in known}
    for f in seen:
        if f.name in held and held[f.name].dataType != f.dataType:
            raise ValueError(f"column {f.name} is {held[f.name].dataType.simpleString()}, not {f.dataType.simpleString()}")
    return T.StructType([*known, *(f for f in seen if f.name not in held)])


def upsert(
    spark: SparkSession, root: str, updates: DataFrame, keys: Sequence[str], buckets: int = BUCKETS
) -> Version:
    """Upsert into the keyed table at `root`; `updates` holds one row per key.

    Keys are looked up in the buckets of the updates alone, over their key columns. Rewritten, and
    written once, are only the parts (month and bucket) in which such a key sits now or will sit,
    so a late row costs one bucket of its month, and a key may move to another month. All parts
    change in one commit: readers see the table before or after it, and a job that dies before
    the commit has changed nothing.
    """
    table = keyed_table(spark, root)
    before, number = table.next_number()
    if before is None:
        return rewrite(spark, root, updates, keys, buckets)
    if before.facts["keys"] != list(keys):
        raise ValueError(f"{root} is keyed by {before.facts['keys']}, not {list(keys)}")
    rows = updates.withColumn(BUCKET, bucket_of(keys, before.facts["buckets"]))
    schema = merged_schema(before.schema, rows.schema)
    # Stored once: the updates are needed for the buckets, the key scan and the merge.
    side = f"{root}/updates"
    rows.write.mode("overwrite").parquet(side)
    rows = spark.read.schema(rows.schema).parquet(side)

    def name(row) -> tuple[str | None, str]:
        return row[MONTH], str(row[BUCKET])

    places = [F.col(MONTH).cast("string").alias(MONTH), BUCKET]
    parts = {name(r) for r in rows.select(*places).distinct().collect()}  # no more than parts
    used = {bucket for _, bucket in parts}
    known = table.read(before, lambda v: v[BUCKET] in used).select(*{*keys, MONTH, BUCKET})
    held = known.join(rows.select(*keys), list(keys), "left_semi").select(*places).distinct()
    parts |= {name(r) for r in held.collect()}

    def touched(values: dict) -> bool:
        return (values[MONTH], values[BUCKET]) in parts

    merged = merge_rows(table.read(before, touched), rows, keys)
    folders = table.write(merged.select(*schema.names), number)
    kept = [f for f in before.folders if not touched(values_of(f))]
    done = table.commit(before, [*kept, *folders], schema, **before.facts)
    files.delete(spark, side)
    return done


def rewrite(
    spark: SparkSession, root: str, rows: DataFrame, keys: Sequence[str], buckets: int = BUCKETS
) -> Version:
    """Make `rows` the whole keyed table; one row per key."""
    table = keyed_table(spark, root)
    before, number = table.next_number()
    rows = rows.withColumn(BUCKET, bucket_of(keys, buckets))
    folders = table.write(rows, number)
    return table.commit(before, folders, rows.schema, keys=list(keys), buckets=buckets)


def changed_months(before: Iterable[str], after: Iterable[str]) -> frozenset[str]:
    """Months in which two versions of a keyed table, given by their folders, may differ."""
    months = {values_of(f)[MONTH] for f in set(before) ^ set(after)}
    return frozenset(m for m in months if m is not None)


def replace_months(
    spark: SparkSession, root: str, rows: DataFrame, since: str | Months | None = None
) -> Version:
    """Make `rows` the table's months from `since` on, or the whole table; in one commit.

    A month of that range that `rows` lacks is gone afterwards, so an incremental run that empties
    a month leaves what a full one would. Other months, and rows without one, stay.
    """
    table = VersionedTable(spark, root, (MONTH,))
    before, number = table.next_number()
    months = Months(since) if isinstance(since, str) else since
    kept = []
    if months is not None:
        kept = [f for f in before.folders if not months.hold(values_of(f)[MONTH])] if before else []
        rows = rows.filter(months.column(MONTH))
    schema = merged_schema(before.schema, rows.schema) if kept else rows.schema
    return table.commit(before, [*kept, *table.write(rows, number)], schema)

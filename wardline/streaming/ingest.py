"""Append new raw files to a table, exactly once, with lineage columns; columns may be added and
may change their type."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.context import RunContext, utc
from wardline.fixed_values import INGEST_COLUMNS, RAW_FEEDS
from wardline.functions.keys import row_hash
from wardline.operators.quality import null_counts
from wardline.sources import files
from wardline.sources.tables import clean_location

INGEST_SCHEMA = (
    "_row_hash string, _ingested_at timestamp, _source_file string, _ingest_date string, "
    "_job_run_id string, _notebook_path string, _source_system string"
)
#: Files of a batch, whose names pass through the driver.
MAX_FILES = 1000
# What the file stream needs to know of a file: where it is. Its content is read per batch.
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def with_ingest_columns(df: DataFrame, ctx: RunContext) -> DataFrame:
    """The seven lineage columns. The hash covers the source columns only, so the same row
    ingested again has the same hash."""
    return df.withColumns(
        {
            "_row_hash": row_hash(df.columns),
            "_ingested_at": utc(ctx.run_ts),
            "_source_file": F.col("_metadata.file_path"),
            "_ingest_date": F.lit(ctx.run_ts.strftime("%Y-%m-%d")),
            "_job_run_id": F.lit(ctx.run_id),
            "_notebook_path": F.lit(ctx.job_path),
            "_source_system": F.lit(ctx.source_system),
        }
    )


def schema_path(target: str, feed: str) -> str:
    return f"{target}/{feed}.schema.json"


def stored_fields(spark: SparkSession, target: str, feed: str) -> list[T.StructField]:
    state = files.from_json(files.read_text(spark, schema_path(target, feed)))
    return T.StructType.fromJson(state["schema"]).fields if state else []


#: Types by which a column may grow where files are read with the wider one.
_WIDER = {
    "tinyint": ("smallint", "int", "bigint"),
    "smallint": ("int", "bigint"),
    "int": ("bigint", "double"),
    "float": ("double",),
    "date": ("timestamp_ntz",),
}
#: Ending of the column that keeps the text of values their column's type cannot hold.
ASIDE = "__text"


def wider(known: T.DataType, seen: T.DataType) -> T.DataType | None:
    """The type that holds values of both, if one does and stored files can be read with it."""
    a, b = known.simpleString(), seen.simpleString()
    if a == b or a in _WIDER.get(b, ()) or (known == T.StringType() and isinstance(seen, T.AtomicType)):
        return known
    return seen if b in _WIDER.get(a, ()) else None


def grown_schema(known: list[T.StructField], seen: T.StructType) -> list[T.StructField]:
    """The feed's columns once rows of schema `seen` are in: none dropped, new ones added, some
    wider. A column whose new type does not go with the old one gets a text column beside it."""
    fields = {f.name: f for f in known}
    for f in seen.fields:
        if f.name not in fields:
            fields[f.name] = T.StructField(f.name, f.dataType)
            continue
        kind = wider(fields[f.name].dataType, f.dataType)
        if kind is None:
            fields.setdefault(f.name + ASIDE, T.StructField(f.name + ASIDE, T.StringType()))
        else:
            fields[f.name] = T.StructField(f.name, kind)
    return list(fields.values())


def fitted(df: DataFrame, seen: T.StructType, fields: list[T.StructField]) -> DataFrame:
    """Rows of schema `seen` in the feed's types. What a type cannot hold is NULL there and kept as
    text beside it, so no value is lost."""
    kinds, columns = {f.name: f.dataType for f in fields}, {}
    for f in seen.fields:
        kind = kinds[f.name]
        if f.dataType == kind:
            continue
        if wider(kind, f.dataType) == kind:
            columns[f.name] = F.col(f.name).cast(kind)
            continue
        simple = isinstance(f.dataType, T.AtomicType)
        text = F.col(f.name).cast("string") if simple else F.to_json(F.struct(f.name))
        columns[f.name + ASIDE] = text
        reads = simple and isinstance(kind, T.AtomicType)
        columns[f.name] = text.try_cast(kind) if reads else F.lit(None).cast(kind)
    return df.withColumns(columns)


def same_schema_groups(spark: SparkSession, paths: list[str]) -> list[DataFrame]:
    """Readers over the paths, as few as their columns' types allow: paths whose types clash are
    split in halves until they do not."""
    # Folder names say where a file came from and are not data.
    reader = spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true")
    try:
        return [reader.parquet(*paths)]
    except (PySparkException, Py4JJavaError) as clash:
        if len(paths) == 1 or "CANNOT_MERGE" not in str(clash):
            raise
    half = len(paths) // 2
    return same_schema_groups(spark, paths[:half]) + same_schema_groups(spark, paths[half:])


def ingest_files(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    ctx: RunContext,
    feed: str = "main",
    pattern: str | None = None,
    max_files: int = MAX_FILES,
) -> int:
    """Process every file not seen before and stop; returns the rows this run added.

    The stream hands over file names alone, `max_files` at a time, so a first run over very many
    files never holds more names than that. Schema and rows of a batch are read from that same
    list, so a file's columns are never missed, however old or late the file is. Each batch is
    complete in a side folder before it is moved to `_ingest_date=.../_batch=...`; a repeated
    batch has the same number and takes the place of its first try. Each feed of a table has its
    own folder and checkpoint, so several sources can fill one table.
    """
    root, date = f"{target}/{feed}", ctx.run_ts.strftime("%Y-%m-%d")
    added: list[int] = []

    def take(batch: DataFrame, number: int) -> None:
        paths = sorted(r["path"] for r in batch.select("path").collect())  # at most max_files names
        if not paths:
            return
        groups = same_schema_groups(spark, paths)
        known = fields = stored_fields(spark, target, feed)
        for rows in groups:
            fields = grown_schema(fields, rows.schema)
        if fields != known:
            text = files.to_json({"schema": T.StructType(fields).jsonValue()})
            files.write_text(spark, schema_path(target, feed), text)
        parts = [fitted(with_ingest_columns(rows, ctx), rows.schema, fields) for rows in groups]
        whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        side, seen = f"{target}/_{feed}.batch={number}", Observation()
        counted = whole.drop("_ingest_date").observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.write.mode("overwrite").parquet(side)
        added.append(seen.get["rows"])
        for earlier in files.matching(spark, f"{root}/*/_batch={number}"):
            files.delete(spark, earlier)
        files.rename(spark, side, f"{root}/_ingest_date={date}/_batch={number}")

    reader = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("recursiveFileLookup", "true")
    # By default the stream passes over files a week older than the newest, such as copies that
    # keep their times.
    reader = reader.option("maxFileAge", "36500d")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    reader = reader.option("maxFilesPerTrigger", max_files)
    query = (
        reader.load(source)
        .select("path")
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", f"{checkpoint}/{feed}")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception():
        raise RuntimeError(f"ingest of {source} failed") from query.exception()
    return sum(added)


def ingest_all(
    spark: SparkSession, landing: str, raw: str, checkpoint: str, ctx: RunContext
) -> dict[str, int]:
    """Take in the new files of every feed that has landed any, check the lineage of what was
    added, and return the rows added by raw table. Locations must be absolute."""
    landing, raw, checkpoint = map(clean_location, (landing, raw, checkpoint))
    added: dict[str, int] = {}
    for table, feeds in RAW_FEEDS.items():
        for feed in feeds:
            source = f"{landing}/{feed}"
            if files.exists(spark, source):
                rows = ingest_files(spark, source, f"{raw}/{table}", checkpoint, ctx, feed)
                added[table] = added.get(table, 0) + rows
                if rows:
                    today = F.col("_ingest_date") == ctx.run_ts.strftime("%Y-%m-%d")
                    batch = read_raw_table(spark, f"{raw}/{table}", [feed]).filter(today)
                    validate_batch(batch, ctx.run_id)
    return added


def raw_tables(spark: SparkSession, raw: str) -> dict[str, DataFrame]:
    """The raw tables by name, each over all its feeds."""
    return {t: read_raw_table(spark, f"{raw}/{t}", feeds) for t, feeds in RAW_FEEDS.items()}


def read_raw_table(
    spark: SparkSession, target: str, feeds: Sequence[str] = ("main",)
) -> DataFrame:
    """The raw table over its feeds, partitioned by ingest date; columns a file lacked are NULL.
    The schema is the stored one, so no file needs to be opened to find it."""
    table = None
    for feed in feeds:
        if not files.exists(spark, f"{target}/{feed}"):
            continue
        lineage = T.StructType.fromDDL(INGEST_SCHEMA).fields
        schema = T.StructType(stored_fields(spark, target, feed) + lineage + [T.StructField("_batch", T.LongType())])
        part = spark.read.schema(schema).parquet(f"{target}/{feed}").drop("_batch")
        table = part if table is None else table.unionByName(part, allowMissingColumns=True)
    if table is None:
        raise ValueError(f"no rows were ever ingested into {target}")
    return table


def validate_batch(table: DataFrame, run_id: str | None = None) -> int:
    """Lineage columns present and filled for the run's rows; returns their number."""
    missing = [c for c in INGEST_COLUMNS if c not in table.columns]
    if missing:
        raise ValueError(f"missing lineage columns {missing}")
    batch = table if run_id is None else table.filter(F.col("_job_run_id") == run_id)
    counts = null_counts(batch, INGEST_COLUMNS).first().asDict()
    rows = counts.pop("rows")
    if not rows:
        raise ValueError(f"no rows found for run {run_id}")
    bad = {c: n for c, n in counts.items() if n}
    if bad:
        raise ValueError(f"NULL lineage values: {bad}")
    return rows

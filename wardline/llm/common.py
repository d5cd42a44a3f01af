"""Tables, stored intermediates and batch helpers of the corpus operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.context import shared_folder

#: Rows with this remainder of crc32(doc_id) are held out of all training.
FOLDS, HELD_OUT = 5, 0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the cluster's shared folder and read back: lineage ends there."""
    path = f"{shared_folder(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Removes the files of a stored table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()[:1]}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Rows of a batch between Spark and Python. Texts are large, so batches of Spark's usual 10,000
#: rows would take up a Python worker's memory several times over.
BATCH_ROWS = "500"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Give this package to the executors, once a session, as --py-files would, and keep batches
    small unless the session says otherwise."""
    context = spark.sparkContext
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, BATCH_ROWS)
    if getattr(context, "_wardline_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    path = os.path.join(tempfile.mkdtemp(prefix="wardline-"), "wardline_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    context.addPyFile(path)
    context._wardline_shipped = True


def map_batches(df: DataFrame, work: Callable, schema: str) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(work, schema)


def map_groups(df: DataFrame, keys: list[str], work: Callable, schema: str) -> DataFrame:
    ship(df.sparkSession)
    return df.groupBy(*keys).applyInArrow(work, schema)


def held_out(doc_id: Column) -> Column:
    """True for rows kept out of training; false for a null id."""
    fold = F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % FOLDS
    return F.coalesce(fold == HELD_OUT, F.lit(False))


def slices(batch: pa.RecordBatch, column: str, most: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about `most` bytes of `column`, whole rows each; null text is ''."""
    at = batch.schema.get_field_index(column)
    text = pc.fill_null(batch.column(at), "")
    batch = batch.set_column(at, column, text)
    sizes = pc.binary_length(text).to_numpy(zero_copy_only=False)
    begin, total = 0, 0
    for row, size in enumerate(sizes):
        if total and total + size > most:
            yield batch.slice(begin, row - begin)
            begin, total = row, 0
        total += int(size)
    if begin < len(sizes):
        yield batch.slice(begin)


def record(schema: pa.Schema, *columns) -> pa.RecordBatch:
    arrays = [
        c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
        for c, f in zip(columns, schema, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


#: Cells of a fixed-size set of hashes (512 KB) and of one of its pages.
CELLS, PAGE = 1 << 22, 1 << 15


def bitmap(df: DataFrame, column: str) -> bytes:
    """Bits of the cells that the column's 64-bit hashes fall into: at most 128 rows reach the driver."""
    cells = df.select(F.pmod(column, F.lit(CELLS)).alias("cell"))
    pages = (
        cells.groupBy((F.col("cell") / PAGE).cast("long").alias("page"))
        .agg(F.bitmap_construct_agg(F.col("cell") % PAGE).alias("bits"))
        .collect()
    )
    out = bytearray(CELLS // 8)
    for p in pages:
        out[p["page"] * PAGE // 8 : (p["page"] + 1) * PAGE // 8] = p["bits"]
    return bytes(out)

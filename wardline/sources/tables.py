"""Reading and registering tables, reference files and polygons."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.fixed_values import GOLD_AUDIT_COLUMNS
from wardline.operators.spatial import geojson_edges
from wardline.sources import files

SEED_SCHEMAS = {
    "zip_codes": "zip_code string, borough string, neighborhood_name string, nta_code string",
    "complaint_types": (
        "complaint_type string, category string, subcategory string, responsible_agency string"
    ),
    "permit_types": (
        "permit_type string, permit_type_desc string, job_type string, work_category string"
    ),
}

# Both layouts of the polygon file: a feature collection, or flat records.
POLYGON_FILE_SCHEMA = """
    features array<struct<
        properties: struct<modzcta: string, zcta5ce10: string, zip_code: string>,
        geometry: string>>,
    modzcta string, zcta5ce10 string, zip_code string, the_geom string, geometry string
"""

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def schema_for(layer: str | None, default: str = "silver") -> str:
    """Namespace of a model: its own if it names one, else the default."""
    return (layer or default).strip()


def quoted(*names: str) -> str:
    for name in names:
        if not _NAME.fullmatch(name):
            raise ValueError(f"not a plain table name: {name!r}")
    return ".".join(f"`{n}`" for n in names)


def clean_location(path: str) -> str:
    """A folder without the trailing slash; empty or relative paths are refused."""
    path = (path or "").strip()
    if not (path.startswith("/") or re.match(r"[a-z][a-z0-9+.-]*:/", path)):
        raise ValueError(f"not an absolute location: {path!r}")
    return path.rstrip("/")


def register_table(spark: SparkSession, namespace: str, name: str, location: str) -> str:
    """External parquet table over a folder; calling it again changes nothing."""
    full = quoted(namespace, name)
    location = clean_location(location).replace("'", "\\'")
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted(namespace)}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {full} USING parquet LOCATION '{location}'")
    return full


def without_audit(df: DataFrame) -> DataFrame:
    return df.drop(*GOLD_AUDIT_COLUMNS)


def scan_nonempty(df: DataFrame, name: str) -> DataFrame:
    """The table without audit columns; an empty table is an error."""
    if df.isEmpty():
        raise ValueError(f"table {name} has no rows")
    return without_audit(df)


def read_seed(spark: SparkSession, seed: str, path: str) -> DataFrame:
    """Reference CSV with declared text columns."""
    return spark.read.schema(SEED_SCHEMAS[seed]).option("header", True).csv(path)


def read_polygon_file(spark: SparkSession, path: str) -> DataFrame:
    """Polygon file -> (zip_code, edges). The reference file is one JSON document."""
    raw = spark.read.schema(POLYGON_FILE_SCHEMA).option("multiLine", True).json(path)
    flat = raw.filter(F.col("features").isNull()).select(
        F.coalesce("modzcta", "zcta5ce10", "zip_code").alias("zip_code"),
        F.coalesce("the_geom", "geometry").alias("geometry"),
    )
    nested = raw.select(F.explode("features").alias("f")).select(
        F.coalesce("f.properties.modzcta", "f.properties.zcta5ce10", "f.properties.zip_code").alias(
            "zip_code"
        ),
        F.col("f.geometry").alias("geometry"),
    )
    return (
        flat.unionByName(nested)
        .select(F.trim("zip_code").alias("zip_code"), geojson_edges(F.col("geometry")).alias("edges"))
        .filter(F.col("zip_code") != "")
    )


def load_polygons(
    spark: SparkSession, source: str, target: str, refresh: bool = False
) -> DataFrame:
    """Load the polygon file into its table. A filled table is left alone unless `refresh`."""
    filled = files.exists(spark, target) and not spark.read.parquet(target).isEmpty()
    if refresh or not filled:
        read_polygon_file(spark, source).write.mode("overwrite").parquet(target)
        bad = spark.read.parquet(target).filter(F.col("edges").isNull()).count()
        if bad:
            raise ValueError(f"{bad} polygons could not be parsed")
    return spark.read.parquet(target)

from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from wardline.context import RunContext, build_session  # noqa: E402
from wardline.plans import staging  # noqa: E402

TESTDATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        4,
        **{
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="wardline-tests-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


@pytest.fixture
def ctx():
    return RunContext(
        as_of=dt.date(2024, 3, 15), run_ts=dt.datetime(2024, 3, 15, 6), run_id="run-1"
    )


DEFAULTS = {
    "complaints": {
        "unique_key": "1",
        "created_date": "2024-01-15T00:00:00.000",
        "closed_date": "2024-01-15T05:30:00.000",
        "complaint_type": "Noise - Street",
        "status": "Open",
        "incident_zip": "10001",
        "borough": "MANHATTAN",
        "latitude": "40.7",
        "longitude": "-73.9",
        "bbl": "1000010001",
        "agency": "DEP",
        "descriptor": "Loud",
    },
    "arrests": {
        "arrest_key": "1",
        "arrest_date": "2024-01-20T00:00:00.000",
        "law_cat_cd": "F",
        "arrest_boro": "M",
        "latitude": "1",
        "longitude": "1",
        "pd_cd": "100",
        "age_group": "25-44",
        "perp_sex": "F",
    },
    "permits": {
        "job__": "J1",
        "permit_sequence__": "01",
        "borough": "1",
        "zip_code": "10001",
        "job_type": "NB",
        "issuance_date": "2024-01-10T00:00:00.000",
        "expiration_date": "2024-12-31T00:00:00.000",
        "permit_type": "NB",
    },
    "inspections": {
        "camis": "R1",
        "inspection_date": "2024-01-05T00:00:00.000",
        "violation_code": "04L",
        "inspection_type": "Cycle",
        "dba": "Cafe",
        "cuisine_description": "Thai",
        "boro": "Manhattan",
        "zipcode": "10001",
        "critical_flag": "Critical",
        "score": "12",
        "grade": "A",
        "grade_date": "2024-01-05T00:00:00.000",
    },
}
SOURCES = {
    "complaints": staging.COMPLAINTS,
    "arrests": staging.ARRESTS,
    "permits": staging.PERMITS,
    "inspections": staging.INSPECTIONS,
}


@pytest.fixture
def raw(spark):
    """raw(source, row, row, ...): raw rows from the defaults plus the given differences."""

    def make(source: str, *rows: dict):
        columns = [*SOURCES[source].raw_columns, "_row_hash", "_source_file", "_ingest_date"]
        data = []
        for i, row in enumerate(rows):
            full = {**DEFAULTS[source], "_row_hash": f"h{i}", **row}
            loaded = full.get("_ingested_at", dt.datetime(2024, 2, 1))
            data.append((*[full.get(c) for c in columns], loaded))
        schema = ", ".join(f"`{c}` string" for c in columns) + ", _ingested_at timestamp"
        return spark.createDataFrame(data, schema)

    return make


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def one(df, *columns):
    found = rows(df, *columns)
    assert len(found) == 1, found
    return found[0]


def plan_of(df) -> str:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


__all__ = ["F", "one", "plan_of", "rows"]

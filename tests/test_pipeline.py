import datetime as dt

import pytest
from conftest import rows

from wardline import fixed_values as fv
from wardline.context import RunContext
from wardline.operators.spatial import polygon_table
from wardline.plans.pipeline import Pipeline
from wardline.sources.exports import load_exports
from wardline.sources.extract import extract_new_rows
from wardline.streaming import ingest_all, raw_tables

ZIP = '{"type":"Polygon","coordinates":[[[0,0],[4,0],[4,4],[0,4],[0,0]]]}'


def context(day, run):
    return RunContext(as_of=day, run_ts=dt.datetime.combine(day, dt.time(6)), run_id=run)


DAY1, DAY2 = dt.date(2024, 3, 15), dt.date(2024, 3, 20)
FIRST = {
    "complaints": [
        {"unique_key": "1", "created_date": "2024-01-15", "status": "Open"},
        {"unique_key": "2", "created_date": "2024-03-01", "status": "Open"},
        {"unique_key": "3", "created_date": "2024-03-02", "borough": "K", "incident_zip": "11201"},
    ],
    "arrests": [{"arrest_key": "1", "arrest_date": "2024-03-03"}, {"arrest_key": "2", "latitude": "nan"}],
    "permits": [{"job__": "1", "issuance_date": "2024-02-10"}],
    "inspections": [{"inspection_date": "2024-03-01", "grade": "C"}],
}
LATER = dt.datetime(2024, 3, 16)
SECOND = {
    "complaints": [
        {"unique_key": "2", "created_date": "2024-03-01", "status": "Closed", "_ingested_at": LATER},
        {"unique_key": "4", "created_date": "2024-03-18", "_ingested_at": LATER},
    ],
    "arrests": [{"arrest_key": "3", "arrest_date": "2023-11-03", "_ingested_at": LATER}],
    "permits": [{"job__": "1", "issuance_date": "2024-02-10", "job_type": "DM", "_ingested_at": LATER}],
    "inspections": [{"inspection_date": "2024-03-18", "grade": "A", "_ingested_at": LATER}],
}


@pytest.fixture
def build(spark, raw, folder):
    polygons = polygon_table(
        spark.createDataFrame([("10001", ZIP)], "z string, g string"), "z", "g"
    )
    seed = spark.createDataFrame(
        [("10001", "MANHATTAN", "Chelsea", "MN1")],
        "zip_code string, borough string, neighborhood_name string, nta_code string",
    )

    def make(name, day, strict=False):
        return Pipeline(
            spark, f"{folder}/{name}", context(day, f"{name}-{day}"), polygons, seed, 1.0, 2, "2023-06",
            fresh_hours={} if strict else {s: (10**6, 10**6) for s in fv.FRESHNESS_HOURS},
        )

    return make


def sources(raw, *batches):
    return {n: raw(n, *[row for b in batches for row in b[n]]) for n in FIRST}


def gold(pipeline):
    drop = ("_gold_loaded_at", "_gold_run_id", "_gold_model_name")
    return {
        f"{layer}/{name}": rows(
            (lambda df: df.drop(*drop).select(sorted(set(df.columns) - set(drop))))(
                pipeline.read(layer, name)
            )
        )
        for layer, name in (
            ("gold", "zip_codes"), ("gold", "fact"), ("marts", "pulse"), ("marts", "safety"),
            ("marts", "food"), ("marts", "top_types"),
        )
    }


def test_incremental_equals_full(raw, build):
    step = build("steps", DAY1)
    first = step.run(sources(raw, FIRST))
    assert first["incremental"] is False
    assert first["manifest"]["exports"]["neighborhood_pulse_summary"]["rows"] == 2 * 10
    step = build("steps", DAY2)
    assert step.run(sources(raw, FIRST, SECOND))["incremental"] is True

    whole = build("whole", DAY2)
    whole.run(sources(raw, FIRST, SECOND))
    assert gold(step) == gold(whole)

    history = rows(step.restaurant_history(), "restaurant_id", "inspection_grade", "valid_to")
    assert history == sorted(
        [("R1", "C", dt.datetime(2024, 3, 20, 6)), ("R1", "A", None)], key=repr
    )
    with pytest.raises(ValueError, match="not later"):
        build("steps", DAY1 - dt.timedelta(days=1)).keep_history()


def test_run_without_new_rows_changes_nothing(raw, build):
    build("same", DAY1).run(sources(raw, FIRST))
    again = build("same", DAY1)
    before = gold(again)
    again.run(sources(raw, FIRST))
    assert gold(again) == before
    tables = again.register()
    assert tables == again.register() and len(tables) == 4
    assert again.spark.table("gold.zip_codes").count() == again.read("gold", "zip_codes").count()
    again.spark.sql("DROP SCHEMA gold CASCADE")


def test_stale_sources_stop_the_publish(spark, raw, build):
    pipeline = build("stale", DAY1, strict=True)
    with pytest.raises(ValueError, match="freshness:permits"):
        pipeline.run(sources(raw, FIRST))
    with pytest.raises(ValueError, match="nothing was published"):
        load_exports(spark, f"{pipeline.root}/exports")
    states = {r.source: r.status for r in pipeline.freshness(sources(raw, FIRST)).collect()}
    assert states == {"service_requests": "ERROR", "arrests": "PASS", "permits": "ERROR", "inspections": "ERROR"}


def test_emptied_and_early_months(raw, build):
    """A row leaves the only month it was in, and one from before the lookback moves: as in a full run."""
    first = {**FIRST, "permits": [{"job__": "1", "issuance_date": "2024-02-10"}, {"job__": "2", "issuance_date": "2023-07-01"}]}
    later = {**SECOND, "permits": [
        {"job__": "1", "issuance_date": "2024-03-10", "_ingested_at": LATER},
        {"job__": "2", "issuance_date": "2023-08-01", "_ingested_at": LATER},
    ]}
    build("move", DAY1).run(sources(raw, first))
    step = build("move", DAY2)
    step.run(sources(raw, first, later))
    whole = build("moved", DAY2)
    whole.run(sources(raw, first, later))
    assert gold(step) == gold(whole)
    months = lambda p: rows(p.read("monthly", "permits"), "year_month")
    assert months(step) == months(whole) == [("2023-08",), ("2024-03",)]


def test_from_source_rows_to_exports(spark, raw, build, folder):
    """Extract pages, ingest the landed files, run the flow; a second round adds its rows."""
    feeds = {
        "service_requests": "complaints", "arrests_historic": "arrests", "permits": "permits",
        "inspections": "inspections",
    }

    def round_trip(batches, day, run):
        ctx = context(day, run)
        for feed, name in feeds.items():
            source = raw(name, *[row for b in batches for row in b[name]])
            source = source.drop("_row_hash", "_ingested_at", "_source_file", "_ingest_date")
            extract_new_rows(
                spark, source, feed, f"{folder}/landing/{feed}", f"{folder}/state/{feed}.json", ctx
            )
        added = ingest_all(spark, f"{folder}/landing", f"{folder}/raw", f"{folder}/cp", ctx)
        pipeline = build("flow", day)
        pipeline.run(raw_tables(spark, f"{folder}/raw"))
        return added, pipeline

    added, pipeline = round_trip([FIRST], DAY1, "a")
    assert added == {"complaints": 3, "arrests": 2, "permits": 1, "inspections": 1}
    assert "run" not in raw_tables(spark, f"{folder}/raw")["permits"].columns
    added, pipeline = round_trip([FIRST, SECOND], DAY2, "b")
    # Rows dated before the cursor, such as a closed complaint, are not extracted again.
    assert added == {"complaints": 1, "arrests": 0, "permits": 0, "inspections": 1}
    assert pipeline.read("silver", "complaints").count() == 4
    assert load_exports(spark, f"{folder}/flow/exports")["complaint_type_rankings"].count() > 0

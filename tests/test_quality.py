import datetime as dt
import json
import re

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from wardline import fixed_values as fv
from wardline.context import RunContext
from wardline.operators import joins, quality
from wardline.sources import exports, files


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [(1, "A", 50.0, "2024-01-01"), (1, "Q", 150.0, "2024-05-01"), (None, None, None, None)],
        "id int, grade string, score double, day string",
    )


def test_checks_in_one_pass(table):
    results = quality.run_checks(
        table,
        "t",
        [
            quality.not_null("id"),
            quality.not_null("id", where=F.col("grade").isNotNull()),
            quality.accepted_values("grade", ["A", "B"], quality.WARN),
            quality.in_range("score", 0, 100),
            quality.not_after("day", dt.date(2024, 3, 1)),
        ],
    )
    assert [tuple(r) for r in results.collect()] == [
        ("t.not_null:id", "error", 1),
        ("t.not_null:id", "error", 0),
        ("t.accepted_values:grade", "warn", 1),
        ("t.in_range:score", "error", 1),
        ("t.not_after:day", "error", 1),
    ]


def test_unique_and_relationship(spark, table):
    assert rows(quality.unique_check(table, "t", ["id"]), "failures") == [(1,)]
    parent = spark.createDataFrame([("A",)], "code string")
    check = quality.relationship_check(table, "t", parent, {"grade": "code"})
    assert rows(check, "check_name", "failures") == [("t.relationship:grade", 1)]
    assert rows(joins.orphan_rows(table, parent, {"grade": "code"}), "grade") == [("Q",)]


def test_unique_keys_of_any_text(spark):
    """MD5s are counted by their bytes; what only looks like one, or has those bytes, is another key."""
    md5 = "900150983cd24fb0d6963f7d28e17f72"
    keys = [
        *[md5, md5, None, None, "", "", "A" * 32, "A" * 32, "é" * 16, "é" * 16],
        *[md5.upper(), md5[:30], md5 + "00", "a" * 32, "0" * 32, "0" * 31, "g" * 32, " " + md5[1:]],
    ]
    table = spark.createDataFrame([(k, i % 2) for i, k in enumerate(keys)], "key string, turn int")
    assert rows(quality.unique_check(table, "t", ["key"]), "failures") == [(5,)]
    assert rows(quality.unique_check(table, "t", ["key", "turn"]), "failures") == [(0,)]
    assert rows(quality.unique_check(table.union(table), "t", ["turn", "key"]), "failures") == [(len(keys),)]


def test_md5_keys_are_shuffled_as_bytes(spark):
    table = spark.range(40_000).select(F.md5(F.col("id").cast("string")).alias("key"))
    text = plan_of(quality.unique_check(table, "t", ["key"]))
    shuffled = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[([^\n]*)\]", text)
    assert any("_md5_0" in columns for columns in shuffled)


def test_severity(table):
    warn = quality.run_checks(table, "t", [quality.not_null("id", quality.WARN)])
    assert quality.enforce(warn) == ["t.not_null:id"]
    with pytest.raises(ValueError, match="t.not_null:id: 1"):
        quality.enforce(quality.run_checks(table, "t", [quality.not_null("id")]))


def test_future_rows_mix_key_types(spark, table):
    other = spark.createDataFrame([("k", dt.date(2025, 1, 1))], "key string, at date")
    found = quality.future_rows({"a": (table, "id", "day"), "b": (other, "key", "at")}, dt.date(2024, 3, 1))
    assert rows(found) == [("a", "1", dt.date(2024, 5, 1)), ("b", "k", dt.date(2025, 1, 1))]


@pytest.mark.parametrize(("hours", "status"), [(25, "PASS"), (26, "WARN"), (49, "WARN"), (50, "ERROR")])
def test_freshness(spark, hours, status):
    now = dt.datetime(2024, 3, 10)
    df = spark.createDataFrame([(now - dt.timedelta(hours=hours),)], "_ingested_at timestamp")
    assert rows(quality.freshness(df, "s", now, 25, 49), "age_hours", "status") == [(hours, status)]


def test_freshness_counts_minutes(spark):
    now = dt.datetime(2024, 3, 10)
    df = spark.createDataFrame([(now - dt.timedelta(hours=25, minutes=59),)], "_ingested_at timestamp")
    assert rows(quality.freshness(df, "s", now, 25, 49), "age_hours", "status") == [(25, "WARN")]


def test_freshness_of_an_empty_source(spark):
    empty = spark.createDataFrame([], "_ingested_at timestamp")
    assert rows(quality.freshness(empty, "s", dt.datetime(2024, 3, 10), 25, 49), "status") == [("ERROR",)]


def export_frames(spark, **changes):
    frames = {}
    for name, columns in fv.EXPORT_REQUIRED.items():
        frames[name] = spark.range(2).select(*[F.lit("x").alias(c) for c in columns])
    return {**frames, **changes}


def test_publish_and_manifest(spark, folder):
    ctx = RunContext(run_ts=dt.datetime(2024, 3, 1, 2, 3, 4), run_id="r1")
    frames = export_frames(spark)
    frames["food_compliance_overview"] = frames["food_compliance_overview"].union(
        frames["food_compliance_overview"]
    )
    exports.publish(spark, frames, folder, ctx)
    manifest = json.loads(files.read_text(spark, f"{folder}/latest/manifest.json"))
    assert manifest["exports"]["food_compliance_overview"]["rows"] == 4
    assert all(e["bytes"] > 0 for e in manifest["exports"].values())
    loaded = exports.load_exports(spark, folder)
    assert {n: df.count() for n, df in loaded.items()}["neighborhood_pulse_summary"] == 2
    assert len(loaded["complaint_type_rankings"].inputFiles()) == 1
    # the next run replaces `latest`
    exports.publish(spark, export_frames(spark), folder, RunContext(run_id="r2"))
    assert exports.load_exports(spark, folder)["food_compliance_overview"].count() == 2


def test_large_exports_are_refused_or_become_several_files(spark, folder):
    exports.publish(spark, export_frames(spark), folder, RunContext(run_id="r0"))
    with pytest.raises(ValueError, match="limit 10"):
        exports.publish(spark, export_frames(spark), folder, RunContext(run_id="r1"), limit=10)
    assert json.loads(files.read_text(spark, f"{folder}/latest/manifest.json"))["run_id"] == "r0"
    with pytest.warns(UserWarning, match="several files"):
        exports.publish(spark, export_frames(spark), folder, RunContext(run_id="r1"), limit=10, allow_parts=True)
    assert exports.load_exports(spark, folder)["complaint_type_rankings"].count() == 2
    assert not exports.export_states(spark, folder).filter("within_limit").count()


def test_readers_see_one_run(spark, folder, monkeypatch):
    """At whatever step a publish stands or dies, all exports come from one run."""
    exports.publish(spark, export_frames(spark), folder, RunContext(run_id="r1"))
    held = exports.load_exports(spark, folder)
    wide = {n: df.union(df) for n, df in export_frames(spark).items()}
    seen = []

    def counts():
        return {df.count() for df in exports.load_exports(spark, folder).values()}

    for step in ("rename", "delete", "size_of", "write_text"):
        real = getattr(files, step)
        monkeypatch.setattr(files, step, lambda *a, real=real: (seen.append(counts()), real(*a))[1])
    exports.publish(spark, wide, folder, RunContext(run_id="r2"))
    monkeypatch.undo()
    assert len(seen) > 10 and all(s in ({2}, {4}) for s in seen) and counts() == {4}
    assert {df.count() for df in held.values()} == {2}  # those who opened the run before still read it
    monkeypatch.setattr(files, "write_text", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        exports.publish(spark, export_frames(spark), folder, RunContext(run_id="r3"))
    monkeypatch.undo()
    assert counts() == {4}
    exports.publish(spark, export_frames(spark), folder, RunContext(run_id="r4"))
    assert counts() == {2} and len(files.matching(spark, f"{folder}/runs/*")) == 2


def test_export_states_notice_changed_files(spark, folder):
    exports.publish(spark, export_frames(spark), folder, RunContext(run_id="r1"))
    assert exports.export_states(spark, folder).filter("size(problems) > 0").count() == 0
    entries = json.loads(files.read_text(spark, f"{folder}/latest/manifest.json"))["exports"]
    files.delete(spark, entries["borough_monthly_trends"]["path"])
    name = "food_compliance_overview"
    export_frames(spark)[name].limit(1).write.mode("overwrite").parquet(entries[name]["path"])
    bad = exports.export_states(spark, folder).filter("size(problems) > 0").collect()
    assert {r.export for r in bad} == {"borough_monthly_trends", name}
    with pytest.raises(ValueError, match="nothing was published"):
        exports.load_exports(spark, f"{folder}/none")


def test_bad_exports_are_not_promoted(spark, folder):
    exports.publish(spark, export_frames(spark), folder, RunContext(run_id="r1"))
    name = "borough_monthly_trends"
    good = export_frames(spark)[name]
    bad = {
        "no rows": good.filter("false"),
        "missing columns": good.drop("year"),
        "NULLs in borough": good.withColumn("borough", F.lit(None).cast("string")),
    }
    for message, df in bad.items():
        with pytest.raises(ValueError, match=message):
            exports.publish(spark, export_frames(spark, **{name: df}), folder, RunContext(run_id="r2"))
    assert json.loads(files.read_text(spark, f"{folder}/latest/manifest.json"))["run_id"] == "r1"
    errors, count = exports.contract_errors(good, name, size=100, limit=100)
    assert errors == [f"{name}: 100 bytes, limit 100"] and count == 2

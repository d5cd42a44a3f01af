import datetime as dt
import time

import pytest
from conftest import one, rows
from pyspark.sql import functions as F

from wardline import fixed_values as fv
from wardline import functions as fn
from wardline.context import utc


def values(spark, raw, build, kind="string"):
    """Result of a column function for each raw value, in order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(raw)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(build(F.col("v"))).collect()]


def test_naive_moments_are_utc_wherever_the_driver_runs(spark, monkeypatch):
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        column = F.unix_seconds(utc(dt.datetime(2024, 3, 10, 12)))
        assert spark.range(1).select(column).first()[0] == 1710072000
    finally:
        monkeypatch.undo()
        time.tzset()


def test_boroughs(spark):
    raw = [" manhattan ", "k", "3", "Staten Is", "b", "5", "Unspecified", "", None, "X"]
    expected = ["MANHATTAN", "BROOKLYN", "BROOKLYN", "STATEN ISLAND", "BRONX", "STATEN ISLAND"]
    assert values(spark, raw, fn.standardize_borough) == expected + [None] * 4


def test_statuses(spark):
    raw = ["in_progress", "In Progress", " CLOSED ", "", None, "weird", "draft"]
    assert values(spark, raw, fn.normalize_status) == [
        "In Progress", "In Progress", "Closed", "Unspecified", "Unspecified", "Unspecified", "Draft",
    ]


def test_grades(spark):
    raw = ["a", " B ", "nan", "(null)", "", None, "Z"]
    assert values(spark, raw, fn.normalize_grade) == ["A", "B", None, None, None, None, "Z"]
    assert values(spark, raw, fn.grade_number) == [1, 2, None, None, None, None, None]


def test_tolerant_casts(spark):
    assert values(spark, ["12", "nan", "x", None], lambda c: fn.tolerant(c, "int")) == [12, None, None, None]
    assert values(spark, ["1.5", "nan", ""], lambda c: fn.tolerant(c, "double")) == [1.5, None, None]
    assert values(
        spark, ["2024-01-15T00:00:00.000", "01/15/2024", "nan"], lambda c: fn.tolerant(c, "date")
    ) == [dt.date(2024, 1, 15), None, None]
    assert values(spark, ["12345678901"], lambda c: fn.tolerant(c, "decimal(10,0)")) == [None]


def test_clean_text_tokens_are_opt_in(spark):
    raw = [" a ", "nan", " None", "(null)", None]
    assert values(spark, raw, fn.clean_text) == ["a", "nan", "None", "(null)", None]
    assert values(spark, raw, lambda c: fn.clean_text(c, fv.STRICT_TOKENS)) == ["a", None, None, None, None]


@pytest.mark.parametrize(
    ("start", "end", "hours"),
    [
        ("2024-01-01 00:00:00", "2024-01-01 01:59:59", 1),
        ("2024-01-01 01:59:00", "2024-01-01 00:00:00", -1),
        ("2024-01-01 00:00:00", None, None),
    ],
)
def test_hours_truncate_toward_zero(spark, start, end, hours):
    df = spark.createDataFrame([(start, end)], "a string, b string")
    a, b = (F.col(c).cast("timestamp") for c in "ab")
    assert one(df.select(fn.hours_between(a, b))) == (hours,)


def test_safe_divide(spark):
    df = spark.createDataFrame([(1, 3), (1, 0), (1, None), (57, 200)], "a bigint, b bigint")
    got = [r[0] for r in df.select(fn.safe_divide(F.col("a"), F.col("b"), 2)).collect()]
    assert got == [0.33, None, None, 0.29]


def test_surrogate_key_keeps_places(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    keys = [r[0] for r in df.select(fn.surrogate_key(*map(F.col, "xyz"))).collect()]
    assert len(set(keys)) == 2


def test_row_hash_ignores_added_null_column(spark):
    df = spark.createDataFrame([("1", "x")], "id string, v string")
    wide = df.withColumn("extra", F.lit(None).cast("string"))
    assert one(df.select(fn.row_hash(df.columns))) == one(wide.select(fn.row_hash(wide.columns)))


def test_categories_first_match_and_case(spark):
    raw = ["Noise - Street", "Food Building", "HEAT/HOT WATER", "Water System", "Other stuff", None]
    assert values(spark, raw, fn.category_of) == ["Noise", "Food", "Other", "Infrastructure", "Other", "Other"]
    loose = values(spark, raw, lambda c: fn.category_of(c, ignore_case=True))
    assert loose[2] == "Housing"


def test_tiers(spark):
    got = values(spark, [75.0, 74.9, 25.0, 0.0, None], fn.tier, "double")
    assert got == ["excellent", "good", "fair", "poor", "unknown"]
    assert values(spark, [70.0, 30.0], lambda c: fn.tier(c, fv.CITY_TIERS), "double") == ["excellent", "fair"]


def test_months(spark):
    assert fn.lookback_floor(dt.date(2024, 3, 15), 90) == "2023-12"
    assert values(spark, ["2023-11", "2024-12"], lambda c: fn.shift_month(c, 2)) == ["2024-01", "2025-02"]


def test_clamp_and_log(spark):
    assert values(spark, [0, 40, 250], lambda c: fn.clamp_score(c, inverted=True), "bigint") == [100.0, 60.0, 0.0]
    assert values(spark, [0, 40, 250], fn.clamp_score, "bigint") == [0.0, 40.0, 100.0]
    assert values(spark, [0, 9, 99], fn.log_scaled, "bigint") == [0.0, 1.0, 2.0]


def test_audit_columns(spark, ctx):
    df = fn.with_gold_audit(spark.range(1), "m", ctx)
    assert one(df, "_gold_model_name", "_gold_run_id") == ("m", "run-1")
    assert rows(fn.with_staging_audit(spark.range(1), "s", ctx), "_stg_loaded_at") == [(ctx.run_ts,)]

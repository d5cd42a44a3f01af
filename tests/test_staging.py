import datetime as dt

from conftest import one, plan_of, rows

from wardline.operators.dedup import duplicate_keys, keep_latest
from wardline.plans import staging

LATER = dt.datetime(2024, 2, 2)


def test_latest_row_wins_and_ties_are_settled(raw, ctx):
    df = raw(
        "complaints",
        {"unique_key": "1", "status": "Open"},
        {"unique_key": "1", "status": "Closed", "_ingested_at": LATER},
        {"unique_key": "2", "status": "Open", "_row_hash": "b"},
        {"unique_key": "2", "status": "Closed", "_row_hash": "a"},
    )
    staged = staging.stage_complaints(df, ctx)
    assert rows(staged, "complaint_id", "complaint_status") == [(1, "Closed"), (2, "Closed")]


def test_dedup_is_idempotent_and_pruned_before_the_shuffle(raw, ctx):
    df = raw("complaints", {"unique_key": "1"}, {"unique_key": "1"}, {"unique_key": "2"})
    once = keep_latest(df, ["unique_key"])
    assert rows(keep_latest(once, ["unique_key"])) == rows(once)
    assert rows(duplicate_keys(df, ["unique_key"])) == [("1", 2)]
    plan = plan_of(once)
    assert plan.count("WindowGroupLimit") >= 2
    assert "Partial" in plan


def test_complaint_columns(raw, ctx):
    df = raw(
        "complaints",
        {
            "closed_date": "2024-01-14T22:01:00.000",
            "agency": " DEP ",
            "bbl": "12345678901",
            "latitude": "nan",
            "borough": " k ",
            "incident_zip": "nan",
        },
    )
    staged = staging.stage_complaints(df, ctx)
    assert one(
        staged, "responding_agency_code", "borough_block_lot", "latitude", "borough",
        "borough_raw", "resolution_time_hours", "year_month", "zip_code",
    ) == ("DEP", None, None, "BROOKLYN", "k", -1, "2024-01", None)
    kept = staging.stage_complaints(df, ctx, keep_zip=True)
    assert one(kept, "zip_code") == ("nan",)


def test_strict_mode_cleans_every_text_column(raw, ctx):
    df = raw("complaints", {"descriptor": "None", "agency": "nan"})
    loose = staging.stage_complaints(df, ctx)
    assert one(loose, "complaint_descriptor", "responding_agency_code") == ("None", "nan")
    strict = staging.stage_complaints(df, ctx, strict=True)
    assert one(strict, "complaint_descriptor", "responding_agency_code") == (None, None)


def test_unparsable_dates_have_no_month(raw, ctx):
    staged = staging.stage_permits(
        raw("permits", {"issuance_date": "01/15/2024"}, {"job__": "J2", "issuance_date": "nan"}), ctx
    )
    assert rows(staged, "issuance_date", "year_month") == [(None, None), (None, None)]


def test_active_permit_follows_as_of(raw, ctx):
    df = raw(
        "permits",
        {"job__": "A", "expiration_date": "2024-03-15"},
        {"job__": "B", "expiration_date": "2024-03-14"},
        {"job__": "C", "expiration_date": None},
    )
    staged = staging.stage_permits(df, ctx)
    assert rows(staged, "job_number", "is_active_permit") == [("A", 1), ("B", 0), ("C", 0)]


def test_permit_key_uses_both_parts(raw, ctx):
    df = raw("permits", {"job__": "1", "permit_sequence__": "2"}, {"job__": "2", "permit_sequence__": "1"})
    assert staging.stage_permits(df, ctx).select("permit_key").distinct().count() == 2


def test_same_violation_of_two_types_are_two_rows(raw, ctx):
    df = raw("inspections", {}, {"inspection_type": "Re-inspection"})
    assert staging.stage_inspections(df, ctx).count() == 2


def test_redacted_values_only_for_age_and_sex(raw, ctx):
    df = raw(
        "arrests",
        {"age_group": "(null)", "perp_sex": " (null) ", "perp_race": "(null)", "law_cat_cd": "(null)"},
    )
    staged = staging.stage_arrests(df, ctx, None)
    assert one(
        staged, "perpetrator_age_group", "perpetrator_sex", "perpetrator_race", "law_category",
        "zip_code", "zip_code_source",
    ) == (None, None, "(null)", None, "UNKNOWN", "borough_fallback")


def test_columns_not_listed_do_not_survive(raw, ctx, spark):
    from pyspark.sql import functions as F

    df = raw("permits", {}).withColumn("owner_s_phone", F.lit("555"))
    assert "owner_s_phone" not in staging.stage_permits(df, ctx).columns


def test_high_water_mark(raw):
    df = raw("permits", {"job__": "old"}, {"job__": "new", "_ingested_at": LATER})
    assert rows(staging.new_rows(df, dt.datetime(2024, 2, 1)), "job__") == [("new",)]
    assert staging.new_rows(df, None).count() == 2


def test_keys_are_one_by_their_typed_value(raw, ctx):
    first, later = dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 2)
    df = raw(
        "complaints",
        {"unique_key": "1", "status": "Open", "_ingested_at": first},
        {"unique_key": " 1", "status": "Closed", "_ingested_at": later},
        {"unique_key": "01", "status": "Pending", "_ingested_at": first},
        {"unique_key": "x", "_ingested_at": first},
        {"unique_key": "y", "_ingested_at": first},
    )
    staged = staging.stage_complaints(df, ctx)
    assert rows(staged, "complaint_id", "complaint_status") == sorted(
        [(1, "Closed"), (None, "Open"), (None, "Open")], key=repr
    )


def test_whole_hash_stays_out_of_the_dedup_shuffle(spark):
    """Equal load times are settled by the start of the hash and, where that is equal too, by all of it."""
    rows = [
        ("a", 1, "ffff0", 1), ("a", 2, "abcd2", 2), ("a", 2, "abcd1", 3), ("a", 2, "abce0", 4),
        ("b", 1, "00000", 5), ("b", None, "00000", 6), ("b", 1, None, 7), (None, 3, "abcd2", 8), (None, 3, "abcd1", 9),
    ]
    made = spark.createDataFrame(rows, "k string, t int, h string, n int")
    columns = {"key": "k", "_ingested_at": "t", "_row_hash": "lower(h)"}
    source = staging.Source(keys=("key",), columns={"key": ("key", staging.TEXT)})
    kept = staging.RawRows(made, columns).latest_rows(source).rows
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "_row_hash" not in plan
    assert sorted(r.n for r in kept.collect()) == [3, 5, 9]

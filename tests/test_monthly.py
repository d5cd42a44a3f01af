import datetime as dt
import random

from conftest import one, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from wardline.plans import monthly, staging


def test_complaint_measures(raw, ctx):
    df = raw(
        "complaints",
        {"unique_key": "1", "complaint_type": "Noise - Street", "status": "Open"},
        {"unique_key": "2", "complaint_type": "noise", "status": "Closed", "closed_date": None},
        {"unique_key": "3", "complaint_type": "Food Poisoning", "status": "Closed"},
        {"unique_key": "4", "complaint_type": "Building/Use", "closed_date": "2024-01-15T06:00:00"},
        {"unique_key": "5", "incident_zip": None},
    )
    got = one(monthly.monthly_complaints(staging.stage_complaints(df, ctx)))
    assert got == ("10001", "2024-01", 4, 1, 1, 1, 5.33, 2, 2)


def test_arrests_leave_out_unknown_zips(raw, ctx):
    staged = staging.stage_arrests(
        raw("arrests", {"arrest_key": "1"}, {"arrest_key": "2", "law_cat_cd": "m"}), ctx, None
    )
    assert rows(monthly.monthly_arrests(staged)) == []
    placed = staged.withColumn("zip_code", F.lit("10001"))
    assert one(monthly.monthly_arrests(placed)) == ("10001", "2024-01", 2, 1, 1, 0)


def test_permit_measures_and_new_as_of(raw, ctx):
    df = raw(
        "permits",
        {"job__": "1", "job_type": "NB", "expiration_date": "2024-03-20"},
        {"job__": "2", "job_type": "A2"},
        {"job__": "3", "job_type": "DM", "expiration_date": "2023-01-01"},
        {"job__": "4", "job_type": "SG"},
    )
    staged = staging.stage_permits(df, ctx)
    assert one(monthly.monthly_permits(staged)) == ("10001", "2024-01", 4, 3, 1, 1, 1)
    later = monthly.monthly_permits(staged, as_of=dt.date(2024, 4, 1))
    assert one(later, "active_permits") == (2,)


def test_a_visit_counts_once_with_its_lowest_violation(raw, ctx):
    df = raw(
        "inspections",
        {"violation_code": "10F", "score": "30", "grade": "C", "critical_flag": "Not Critical"},
        {"violation_code": "04L", "score": "12", "grade": "A"},
        {"violation_code": "04M", "score": "30", "grade": "C"},
    )
    got = one(monthly.monthly_inspections(staging.stage_inspections(df, ctx)))
    assert got == ("10001", "2024-01", 1, 1, 12.0, 1.0, 0.0, 0.0, 2)


def test_null_code_represents_the_visit_and_z_counts_in_the_denominator(raw, ctx):
    df = raw(
        "inspections",
        {"violation_code": None, "grade": "Z", "score": "5"},
        {"violation_code": "04L", "grade": "A", "score": "12"},
        {"camis": "R2", "grade": "A"},
        {"camis": "R3", "grade": None},
    )
    got = one(
        monthly.monthly_inspections(staging.stage_inspections(df, ctx)),
        "total_inspections", "unique_restaurants_inspected", "pct_grade_a", "avg_score",
    )
    assert got == (3, 3, 0.5, 9.67)


def test_month_with_only_later_rows_of_a_visit_drops_out(raw, ctx):
    df = raw(
        "inspections",
        {"violation_code": "01A", "zipcode": "10001"},
        {"violation_code": "02B", "zipcode": "10002"},
    )
    assert rows(monthly.monthly_inspections(staging.stage_inspections(df, ctx)), "zip_code") == [("10001",)]


def test_one_pass_equals_two_passes(raw, ctx):
    rng = random.Random(7)
    data = [
        {
            "camis": f"R{rng.randrange(6)}",
            "inspection_date": f"2024-0{rng.randrange(1, 4)}-0{rng.randrange(1, 4)}",
            "violation_code": rng.choice([None, "01", "02", "03"]),
            "inspection_type": rng.choice(["Cycle", "Initial"]),
            "zipcode": rng.choice(["1", "2", "3"]),
            "score": rng.choice(["5", "13", "nan"]),
            "grade": rng.choice(["A", "B", "C", "Z", None]),
            "critical_flag": rng.choice(["Critical", "Not Critical"]),
        }
        for _ in range(400)
    ]
    staged = staging.stage_inspections(raw("inspections", *data), ctx)
    order = [F.col("violation_code").asc_nulls_first(), F.col("inspection_type").asc_nulls_first()]
    visit = Window.partitionBy("restaurant_id", "inspection_date").orderBy(*order)
    visits = staged.withColumn("n", F.row_number().over(visit)).filter("n = 1")
    graded = F.count("inspection_grade")

    def pct(letter):
        return F.round(F.count_if(F.col("inspection_grade") == letter) / graded, 4)

    spark = staged.sparkSession
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        by_visit = visits.groupBy("zip_code", "year_month").agg(
            F.count(F.lit(1)), F.count_distinct("restaurant_id"), F.round(F.avg("inspection_score"), 2),
            pct("A"), pct("B"), pct("C"),
        )
        by_row = staged.groupBy("zip_code", "year_month").agg(
            F.count_if(F.col("is_critical_violation") == "Critical")
        )
        expected = rows(by_visit.join(by_row, ["zip_code", "year_month"]))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert rows(monthly.monthly_inspections(staged)) == expected


def test_lookback_keeps_whole_months(raw, ctx):
    df = raw("permits", {"job__": "1", "issuance_date": "2023-12-01"}, {"job__": "2", "issuance_date": "2023-11-30"})
    staged = staging.stage_permits(df, ctx)
    assert rows(monthly.monthly_permits(staged, "2023-12"), "year_month") == [("2023-12",)]


def test_permits_fill_with_zero(raw, ctx):
    complaints = monthly.monthly_complaints(staging.stage_complaints(raw("complaints", {}), ctx))
    permits = monthly.monthly_permits(
        staging.stage_permits(raw("permits", {"zip_code": "10002"}), ctx)
    )
    got = one(monthly.complaints_with_permits(complaints, permits), "zip_code", "total_permits_issued", "active_permits")
    assert got == ("10001", 0, 0)

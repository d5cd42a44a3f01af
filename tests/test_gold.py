import datetime as dt

import pytest
from conftest import TESTDATA, one, rows
from pyspark.sql import functions as F

from wardline.operators.ranking import ranked_share, top_ranked
from wardline.operators.spine import month_rows
from wardline.plans import analysis, dims, kpi, marts, monthly, staging
from wardline.plans.fact import fact_neighborhood_monthly, pulse_score
from wardline.plans.registry import all_queries
from wardline.plans.star import stored_star

COMPLAINTS = (
    "zip_code string, year_month string, total_complaints bigint, noise_complaints bigint, "
    "food_complaints bigint, construction_complaints bigint, avg_resolution_hours double, "
    "open_complaints bigint, closed_complaints bigint"
)
ARRESTS = (
    "zip_code string, year_month string, total_arrests bigint, felony_count bigint, "
    "misdemeanor_count bigint, violation_count bigint"
)
PERMITS = (
    "zip_code string, year_month string, total_permits_issued bigint, active_permits bigint, "
    "new_building_count bigint, alteration_count bigint, demolition_count bigint"
)
INSPECTIONS = (
    "zip_code string, year_month string, total_inspections bigint, "
    "unique_restaurants_inspected bigint, avg_score double, pct_grade_a double, "
    "pct_grade_b double, pct_grade_c double, critical_violation_count bigint"
)


@pytest.fixture
def measures(spark):
    return {
        "complaints": spark.createDataFrame([("1", "2024-01", 150, 1, 2, 3, 5.5, 4, 5)], COMPLAINTS),
        "arrests": spark.createDataFrame([("1", "2024-01", 50, 10, 5, 1), ("2", "2024-02", 4, 3, 0, 0)], ARRESTS),
        "permits": spark.createDataFrame([("1", "2024-01", 8, 20, 1, 2, 3), ("3", "2024-01", 2, 1, 0, 0, 0)], PERMITS),
        "inspections": spark.createDataFrame([("1", "2024-01", 10, 9, 11.0, 0.5, 0.25, 0.25, 7)], INSPECTIONS),
    }


@pytest.fixture
def zips(spark):
    return spark.createDataFrame(
        [("1", "BRONX", "A", "X1"), ("2", "QUEENS", "B", "X2"), ("3", "QUEENS", None, None)],
        "zip_code string, borough string, neighborhood_name string, nta_code string",
    )


@pytest.fixture
def fact(spark, measures, zips):
    dates = dims.dim_date(spark, dt.date(2024, 3, 15), "2024-01")
    return fact_neighborhood_monthly(zips, dates, **measures)


def test_dense_grid_and_zero_fill(fact):
    assert fact.count() == 9
    quiet = one(
        fact.filter("zip_code = '2' and year_month = '2024-03'"),
        "total_complaints", "active_permit_count", "avg_resolution_hours", "pct_grade_a", "neighborhood_pulse_score",
    )
    assert quiet == (0, 0, None, None, 70.0)


def test_score(fact):
    got = one(fact.filter("zip_code = '1' and year_month = '2024-01'"), "neighborhood_pulse_score")
    # 98.5 * 0.25 + 99 * 0.25 + 99 * 0.2 + 50 * 0.3 = 84.175, rounded half up
    assert got == (84.18,)


def test_score_is_capped(spark):
    df = spark.createDataFrame(
        [(20000, 9000, 5000, 1.0), (10000, 5000, 2000, None)],
        "total_complaints bigint, total_arrests bigint, active_permit_count bigint, pct_grade_a double",
    )
    assert rows(df.select(pulse_score())) == [(0.0,), (30.0,)]


def test_fact_lookback(spark, measures, zips):
    dates = dims.dim_date(spark, dt.date(2024, 3, 15), "2024-01")
    recent = fact_neighborhood_monthly(zips, dates, **measures, since="2024-02")
    assert recent.count() == 6


def test_dates(spark):
    got = rows(dims.dim_date(spark, dt.date(2024, 3, 15), "2024-01"), "year_month", "quarter", "month_name", "is_current_month", "is_complete_month")
    assert got == [
        ("2024-01", 1, "January", False, True),
        ("2024-02", 1, "February", False, True),
        ("2024-03", 1, "March", True, False),
    ]
    assert month_rows(spark, "2024-01", dt.date(2023, 6, 1)).count() == 0


def test_one_row_per_zip(spark, raw, ctx):
    seed = spark.createDataFrame(
        [("10001", "MANHATTAN", "Chelsea", "MN1")],
        "zip_code string, borough string, neighborhood_name string, nta_code string",
    )
    complaints = staging.stage_complaints(
        raw(
            "complaints",
            {"unique_key": "1", "borough": "Q"},
            {"unique_key": "2", "incident_zip": "20000", "borough": "Q"},
            {"unique_key": "3", "incident_zip": "20000", "borough": "K"},
            {"unique_key": "4", "incident_zip": "20000", "borough": "K"},
            {"unique_key": "5", "incident_zip": "30000", "borough": "S"},
            {"unique_key": "6", "incident_zip": "30000", "borough": "B"},
            {"unique_key": "7", "incident_zip": "40000", "borough": None},
        ),
        ctx,
    )
    got = rows(dims.dim_zip_codes(seed, [complaints]), "zip_code", "borough", "nta_code")
    assert got == [
        ("10001", "MANHATTAN", "MN1"), ("20000", "BROOKLYN", None), ("30000", "BRONX", None), ("40000", None, None),
    ]


def test_full_outer_marts(measures):
    safety = marts.mart_safety_infrastructure(measures["arrests"], measures["permits"])
    assert rows(safety, "zip_code", "total_arrests", "total_permits_issued", "arrests_per_permit", "felony_pct") == [
        ("1", 50, 8, 6.25, 0.2), ("2", 4, 0, None, 0.75), ("3", 0, 2, 0.0, None),
    ]
    food = marts.mart_food_compliance(measures["inspections"].filter("false"), measures["complaints"])
    assert one(food, "total_inspections", "food_complaint_count", "food_complaints_per_inspection", "pct_grade_a") == (0, 2, None, None)


def test_dense_rank_and_share(spark):
    df = spark.createDataFrame(
        [("Q", "a", 5), ("Q", "b", 5), ("Q", "c", 2), ("K", "a", 1)], "g string, t string, n bigint"
    )
    ranked = ranked_share(df, ["g"], "n", "rank", "share")
    assert rows(ranked, "g", "t", "rank", "share") == [
        ("K", "a", 1, 1.0), ("Q", "a", 1, 0.4167), ("Q", "b", 1, 0.4167), ("Q", "c", 2, 0.1667),
    ]
    assert top_ranked(ranked, "rank", 1).count() == 3


def test_top_complaints_leave_out_unknown_boroughs(raw, ctx):
    df = raw("complaints", {"unique_key": "1"}, {"unique_key": "2", "borough": "X"}, {"unique_key": "3", "complaint_type": None})
    mart = marts.mart_top_complaints(staging.stage_complaints(df, ctx))
    assert one(mart) == ("MANHATTAN", "2024-01", "Noise - Street", 1, 1, 1.0)


def test_pulse_summary_windows(spark, fact, zips):
    dates = dims.dim_date(spark, dt.date(2024, 3, 15), "2024-01")
    summary = kpi.neighborhood_pulse_summary(marts.mart_neighborhood_pulse(fact, zips, dates))
    first = one(
        summary.filter("zip_code = '3' and year_month = '2024-01'"),
        "borough_pulse_rank", "borough_zip_count", "pulse_score_prev_month", "pulse_score_mom_delta",
    )
    assert first == (2, 2, None, None)
    second = one(summary.filter("zip_code = '3' and year_month = '2024-02'"), "pulse_score_prev_month", "pulse_score_mom_delta")
    assert second == (69.99, 0.01)
    assert "neighborhood_name" in summary.columns


def test_borough_totals_equal_zip_totals(spark, fact, zips):
    dates = dims.dim_date(spark, dt.date(2024, 3, 15), "2024-01")
    mart = marts.mart_neighborhood_pulse(fact, zips, dates)
    trends = kpi.borough_monthly_trends(mart)
    for column in kpi.TREND_SUMS:
        assert one(trends.agg(F.sum(column))) == one(mart.agg(F.sum(column)))
    assert one(trends.filter("borough = 'QUEENS' and year_month = '2024-01'"), "zip_code_count") == (2,)


PAIRS = (
    "zip_code string, year_month string, noise_complaints bigint, construction_complaints bigint, "
    "total_complaints bigint, new_building_count bigint, total_permits_issued bigint, active_permits bigint"
)


def test_lag_uses_calendar_months(spark):
    pairs = spark.createDataFrame(
        [
            ("1", "2023-11", 1, 1, 1, 7, 8, 9),
            ("1", "2024-01", 2, 2, 2, 3, 4, 5),
            ("1", "2024-02", 3, 3, 3, 0, 0, 0),
            ("2", "2024-02", 4, 4, 4, 0, 0, 0),
            ("3", "2024-02", 0, 0, 0, 0, 0, 0),
        ],
        PAIRS,
    )
    lags = analysis.complaint_permit_lag(pairs)
    got = rows(lags, "zip_code", "year_month", "new_building_count_t_minus_1", "total_permits_t_minus_2")
    assert got == [
        ("1", "2023-11", None, None), ("1", "2024-01", None, 8), ("1", "2024-02", 3, None), ("2", "2024-02", None, None),
    ]


def test_dense_lag_looks_at_permit_months_and_back_on_quiet_ones(spark):
    complaints = spark.createDataFrame(
        [("1", "2024-01", 5, 2, 0, 1, 3.5, 1, 4), ("1", "2024-04", 4, 3, 0, 2, None, 0, 4)], COMPLAINTS
    )
    permits = spark.createDataFrame([("1", "2024-02", 6, 5, 4, 0, 0), ("2", "2024-01", 9, 8, 7, 0, 0)], PERMITS)
    months = [f"2024-0{m}" for m in range(1, 6)]
    grid = spark.createDataFrame([(z, m) for z in "123" for m in months], "zip_code string, year_month string")
    lags = analysis.complaint_permit_lag(monthly.complaints_or_permits(complaints, permits), grid)
    got = rows(lags, "zip_code", "year_month", *analysis.LAG_COLUMNS)
    assert got == [
        ("1", "2024-01", 2, 1, 5, 0, None, None, None, None, None),
        ("1", "2024-02", 0, 0, 0, 4, 0, 0, 0, None, None),
        ("1", "2024-04", 3, 2, 4, 0, 0, 0, 0, 4, 6),
        ("2", "2024-01", 0, 0, 0, 7, None, None, None, None, None),
    ]


def test_dense_lag_query_covers_all_active_months(spark):
    star = stored_star(spark, TESTDATA)
    dense = all_queries()["lag_join_dense"](spark, TESTDATA)
    placed = [df.select("zip_code", "year_month") for df in (star.monthly_complaints, star.monthly_permits)]
    months = rows(placed[0].union(placed[1]).distinct())
    assert rows(dense, "zip_code", "year_month") == months and len(months) > star.pairs.count()
    first = one(star.dates.agg(F.min("year_month")))[0]
    late = dense.filter(F.col("year_month") > first)
    assert late.filter(F.col("total_permits_t_minus_1").isNull()).isEmpty()
    assert one(dense.agg(F.sum("new_building_count_t"))) == one(star.monthly_permits.agg(F.sum("new_building_count")))


def test_newest_restaurant_row(raw, ctx):
    df = raw(
        "inspections",
        {"inspection_date": "2024-01-05", "grade": "C"},
        {"inspection_date": "2024-02-05", "grade": None, "grade_date": None},
        {"inspection_date": "2024-02-05", "violation_code": "10F", "grade": "A", "grade_date": "2024-02-05"},
    )
    current = analysis.current_restaurants(staging.stage_inspections(df, ctx))
    assert one(current, "restaurant_id", "inspection_grade") == ("R1", "A")


def test_seed_takes_the_most_frequent_combination(raw, ctx):
    df = raw(
        "complaints",
        *[{"unique_key": str(i), "descriptor": d, "agency": "A"} for i, d in enumerate("aabbc")],
        {"unique_key": "9", "complaint_type": None},
    )
    got = one(analysis.complaint_type_seed(staging.stage_complaints(df, ctx)))
    assert got == ("Noise - Street", "Noise", "a", "A")

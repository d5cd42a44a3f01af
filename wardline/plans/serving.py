"""Serving queries over the published exports: filters, summaries and chart data.

All parameters are bound values or column expressions, never pasted into SQL text.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline import fixed_values as fv
from wardline.functions import clamp_score, safe_divide, tier

SCORE = "neighborhood_pulse_score"
DOMAINS = {
    "complaints": "total_complaints",
    "arrests": "total_arrests",
    "permits": "total_permits_issued",
    "inspections": "total_inspections",
}


def run_sql(
    spark: SparkSession, sql: str, tables: Mapping[str, DataFrame], args: Mapping[str, object]
) -> DataFrame:
    """SQL over named frames ({name} in the text) with bound parameters (:name)."""
    return spark.sql(sql, args=dict(args), **tables)


def _of(df: DataFrame, month: str | None = None, borough: str | None = None) -> DataFrame:
    if month is not None:
        df = df.filter(F.col("year_month") == month)
    if borough is not None:
        df = df.filter(F.col("borough") == borough)
    return df


def _sums(columns: Mapping[str, str]) -> list[Column]:
    return [F.sum(c).alias(name) for name, c in columns.items()]


def _exact_mean(column: str, digits: int) -> Column:
    """Mean of values with `digits` decimals, independent of row order."""
    return F.avg(F.col(column).cast(f"decimal(18,{digits})")).cast("double")


# --- neighbourhood page -----------------------------------------------------------------


def zip_month(spark: SparkSession, summary: DataFrame, zip_code: str, month: str) -> DataFrame:
    return run_sql(
        spark,
        "SELECT * FROM {summary} WHERE zip_code = :zip AND year_month = :month",
        {"summary": summary},
        {"zip": zip_code, "month": month},
    )


def zip_series(summary: DataFrame, zip_code: str) -> DataFrame:
    """One zip over time; the newest unfinished month is marked."""
    rows = summary.filter(F.col("zip_code") == zip_code)
    open_month = F.when(~F.col("is_complete_month"), F.col("year_month"))
    newest = F.max(open_month).over(Window.partitionBy("zip_code"))
    return rows.withColumn(
        "is_month_to_date", F.coalesce(F.col("year_month") == newest, F.lit(False))
    ).orderBy("year_month")


def place_summary(summary: DataFrame, month: str, borough: str | None = None) -> DataFrame:
    return _of(summary, month, borough).agg(
        _exact_mean(SCORE, 2).alias("avg_score"), *_sums(DOMAINS)
    )


def borough_comparison(trends: DataFrame, month: str) -> DataFrame:
    """Boroughs of a month in their fixed order, with display labels."""
    order = F.array_position(F.array(*[F.lit(b) for b in fv.BOROUGH_ORDER]), F.col("borough"))
    return (
        _of(trends, month)
        .select(
            "borough",
            F.initcap("borough").alias("label"),
            order.cast("int").alias("position"),
            *DOMAINS.values(),
        )
        .orderBy("position")
    )


def score_distribution(
    summary: DataFrame, month: str, borough: str, most: int = fv.TOP_SCORES
) -> DataFrame:
    """The zips with the highest scores, shown from low to high, with their tier."""
    return (
        _of(summary, month, borough)
        .filter(F.col(SCORE).isNotNull())
        .select("zip_code", SCORE, tier(F.col(SCORE)).alias("tier"))
        .orderBy(F.desc(SCORE), "zip_code")
        .limit(most)
        .orderBy(SCORE, F.desc("zip_code"))
    )


def domain_balance(trends: DataFrame) -> DataFrame:
    """Four domains on 0-100; for complaints and arrests fewer is better."""
    return trends.select(
        "borough",
        "year_month",
        clamp_score(F.col("total_complaints"), inverted=True).alias("complaints"),
        clamp_score(F.col("total_arrests"), inverted=True).alias("safety"),
        clamp_score(F.col("total_permits_issued")).alias("infrastructure"),
        clamp_score(F.col("total_inspections")).alias("food_safety"),
    )


# --- complaints page --------------------------------------------------------------------

CATEGORY_SUMS = {
    "noise": "noise_complaint_count",
    "food": "food_complaint_count",
    "construction": "construction_complaint_count",
}


def complaint_summary(summary: DataFrame, month: str, borough: str | None = None) -> DataFrame:
    return _of(summary, month, borough).agg(
        *_sums({"total": "total_complaints", **CATEGORY_SUMS})
    )


def top_types(
    rankings: DataFrame, month: str, borough: str, most: int = fv.TOP_CHART_TYPES
) -> DataFrame:
    """The largest complaint types, shown from small to large."""
    return (
        _of(rankings, month, borough)
        .orderBy(F.desc("complaint_count"), "complaint_type")
        .limit(most)
        .select("complaint_type", "complaint_count", "pct_of_borough_total")
        .orderBy("complaint_count", F.desc("complaint_type"))
    )


def monthly_sums(
    df: DataFrame, columns: Mapping[str, str], borough: str | None = None
) -> DataFrame:
    """Sums by month over all places or one borough."""
    return _of(df, borough=borough).groupBy("year_month").agg(*_sums(columns)).orderBy("year_month")


def category_trend(trends: DataFrame, borough: str | None = None) -> DataFrame:
    return monthly_sums(trends, CATEGORY_SUMS, borough)


def borough_series(trends: DataFrame, measure: str = "total_complaints") -> DataFrame:
    """A measure over time for the known boroughs, as stacked series."""
    return (
        trends.filter(F.col("borough").isin(*fv.BOROUGH_ORDER))
        .select("borough", "year_month", measure)
        .orderBy("borough", "year_month")
    )


def volume_and_resolution(summary: DataFrame, borough: str | None = None) -> DataFrame:
    """Complaints and the plain mean of the zips' mean resolution hours, by month."""
    return (
        _of(summary, borough=borough)
        .groupBy("year_month")
        .agg(
            F.sum("total_complaints").alias("total_complaints"),
            _exact_mean("avg_resolution_hours", 2).alias("avg_resolution_hours"),
        )
        .orderBy("year_month")
    )


# --- safety page ------------------------------------------------------------------------


def safety_summary(trends: DataFrame, month: str, borough: str | None = None) -> DataFrame:
    sums = {
        "arrests": "total_arrests",
        "permits": "total_permits_issued",
        "felonies": "felony_count",
        "misdemeanors": "misdemeanor_count",
    }
    ratio = safe_divide(F.col("arrests"), F.col("permits"), 2)
    return (
        _of(trends, month, borough)
        .agg(*_sums(sums))
        .withColumn("arrests_per_permit", F.coalesce(ratio, F.lit(0.0)))
    )


def safety_scatter(safety: DataFrame, month: str) -> DataFrame:
    return (
        _of(safety, month)
        .filter((F.col("total_arrests") > 0) | (F.col("total_permits_issued") > 0))
        .select(
            "zip_code",
            "total_arrests",
            "total_permits_issued",
            "log_arrests",
            "log_permits",
            F.coalesce("felony_pct", F.lit(0.0)).alias("felony_pct_display"),
        )
    )


def arrest_trend(trends: DataFrame, borough: str | None = None) -> DataFrame:
    columns = ("felony_count", "misdemeanor_count", "total_arrests")
    return monthly_sums(trends, {c: c for c in columns}, borough)


def permit_trend(trends: DataFrame, borough: str | None = None) -> DataFrame:
    return monthly_sums(trends, {"total_permits_issued": "total_permits_issued"}, borough)


def recent_months(trends: DataFrame, most: int = fv.RECENT_MONTHS) -> DataFrame:
    """The newest months with their position, oldest first. At most `most` rows, so the
    unpartitioned window is bounded."""
    newest = trends.select("year_month").distinct().orderBy(F.desc("year_month")).limit(most)
    return newest.withColumn("position", F.row_number().over(Window.orderBy("year_month")))


def permit_ratio_rows(trends: DataFrame, most: int = fv.RECENT_MONTHS) -> DataFrame:
    """Arrests per permit of each borough in the newest months; NULL without permits."""
    return trends.join(recent_months(trends, most), "year_month").select(
        "borough",
        "year_month",
        "position",
        safe_divide(F.col("total_arrests"), F.col("total_permits_issued"), 2).alias(
            "arrests_per_permit"
        ),
    )


def permit_ratio_matrix(trends: DataFrame, most: int = fv.RECENT_MONTHS) -> DataFrame:
    """Boroughs by newest months (m01 = oldest), known boroughs in their fixed order."""
    width = max(2, len(str(most)))
    names = [f"m{i:0{width}d}" for i in range(1, most + 1)]
    order = F.array_position(F.array(*[F.lit(b) for b in fv.BOROUGH_ORDER]), F.col("borough"))
    column = F.concat(F.lit("m"), F.lpad(F.col("position").cast("string"), width, "0"))
    return (
        permit_ratio_rows(trends, most)
        .filter(F.col("borough").isin(*fv.BOROUGH_ORDER))
        .withColumn("slot", column)
        .groupBy("borough")
        .pivot("slot", names)
        .agg(F.first("arrests_per_permit"))
        .orderBy(order)
    )


def arrest_composition(
    summary: DataFrame, month: str | None = None, borough: str | None = None
) -> DataFrame:
    """Totals by category, one row each."""
    sums = {
        "Felonies": "felony_count",
        "Misdemeanors": "misdemeanor_count",
        "Violations": "violation_count",
    }
    return _totals_as_rows(_of(summary, month, borough), sums, "category")


# --- food page --------------------------------------------------------------------------


def food_in_borough(
    food: DataFrame, zips: DataFrame, month: str | None, borough: str | None
) -> DataFrame:
    """Food rows of a borough. The mart has no borough, so it comes from the zip dimension."""
    rows = _of(food, month)
    if borough is None:
        return rows
    return rows.join(_of(zips, borough=borough).select("zip_code"), "zip_code", "left_semi")


def food_summary(
    food: DataFrame, zips: DataFrame, month: str, borough: str | None = None
) -> DataFrame:
    sums = {
        "inspections": "total_inspections",
        "unique_restaurants": "unique_restaurants_inspected",
        "food_complaints": "food_complaint_count",
    }
    return food_in_borough(food, zips, month, borough).agg(
        *_sums(sums), _exact_mean("pct_grade_a", 4).alias("avg_pct_a")
    )


GRADES = ("pct_grade_a", "pct_grade_b", "pct_grade_c")


def _percent(value: Column) -> Column:
    return F.round(value.cast("decimal(18,8)") * 100, 1).cast("double")


def grade_rows(food: DataFrame, month: str) -> DataFrame:
    """Grade shares in percent, one row per graded zip. A chart with many zips takes `grade_means`."""
    rows = _of(food, month).filter(F.col("pct_grade_a").isNotNull())
    return rows.select("zip_code", *[_percent(F.col(g)).alias(g) for g in GRADES])


def grade_means(food: DataFrame, month: str) -> DataFrame:
    """Means of the graded zips' shares in percent: one row, none without a graded zip."""
    rows = _of(food, month).filter(F.col("pct_grade_a").isNotNull())
    means = rows.agg(F.count(F.lit(1)).alias("n"), *[_percent(_exact_mean(g, 4)).alias(g) for g in GRADES])
    return means.filter("n > 0").select(F.lit("ALL").alias("zip_code"), *GRADES)


def compliance_scatter(food: DataFrame, month: str) -> DataFrame:
    """Zips of one month with both measures, and the medians that split the quadrants. The
    exact medians see at most one value per zip."""
    rows = (
        _of(food, month)
        .filter(
            F.col("pct_grade_a").isNotNull() & F.col("food_complaints_per_inspection").isNotNull()
        )
        .select("zip_code", "pct_grade_a", "food_complaints_per_inspection", "total_inspections")
    )

    def middle(column: str) -> Column:
        return rows.agg(F.median(column)).scalar()

    return rows.select(
        "*",
        middle("pct_grade_a").alias("median_grade_a"),
        middle("food_complaints_per_inspection").alias("median_complaints"),
    )


def inspection_volume(food: DataFrame) -> DataFrame:
    columns = ("total_inspections", "unique_restaurants_inspected")
    return monthly_sums(food, {c: c for c in columns})


def grade_a_trend(food: DataFrame) -> DataFrame:
    """Mean share of A grades by month, in percent."""
    mean = F.avg(F.col("pct_grade_a").cast("decimal(18,4)")) * 100
    return (
        food.filter(F.col("pct_grade_a").isNotNull())
        .groupBy("year_month")
        .agg(F.round(mean, 4).cast("double").alias("avg_grade_a"))
        .orderBy("year_month")
    )


def food_and_critical(trends: DataFrame, borough: str | None = None) -> DataFrame:
    columns = ("food_complaint_count", "critical_violation_count")
    return monthly_sums(trends, {c: c for c in columns}, borough)


# --- overview ---------------------------------------------------------------------------


def latest_scores(trends: DataFrame) -> DataFrame:
    """Borough scores of the newest month that has any, from low to high."""
    scored = trends.filter(F.col("avg_pulse_score").isNotNull())
    newest = scored.agg(F.max("year_month").alias("year_month"))
    return (
        scored.join(newest, "year_month", "left_semi")
        .select(
            "borough",
            "year_month",
            "avg_pulse_score",
            tier(F.col("avg_pulse_score")).alias("tier"),
            tier(F.col("avg_pulse_score"), fv.CITY_TIERS).alias("city_tier"),
        )
        .orderBy("avg_pulse_score", "borough")
    )


def monthly_activity(trends: DataFrame) -> DataFrame:
    return monthly_sums(trends, {c: c for c in DOMAINS.values()})


def domain_totals(summary: DataFrame, month: str | None = None) -> DataFrame:
    return _totals_as_rows(_of(summary, month), DOMAINS, "domain")


def export_rows(exports: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each export and of all together."""
    counts = None
    for name, df in exports.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("export"), "row_count"
        )
        counts = one if counts is None else counts.unionByName(one)
    total = counts.agg(F.sum("row_count").alias("row_count")).select(
        F.lit("all").alias("export"), "row_count"
    )
    return counts.unionByName(total)


def boroughs(summary: DataFrame) -> DataFrame:
    return summary.select("borough").filter(F.col("borough").isNotNull()).distinct().orderBy("borough")


def year_months(summary: DataFrame) -> DataFrame:
    return summary.select("year_month").distinct().orderBy(F.desc("year_month"))


def zip_codes(summary: DataFrame, borough: str | None = None) -> DataFrame:
    return _of(summary, borough=borough).select("zip_code").distinct().orderBy("zip_code")


def _totals_as_rows(df: DataFrame, sums: Mapping[str, str], label: str) -> DataFrame:
    rows = F.array(
        *[
            F.struct(F.lit(name).alias(label), F.coalesce(F.sum(c), F.lit(0)).alias("total"))
            for name, c in sums.items()
        ]
    )
    return df.agg(rows.alias("r")).select(F.explode("r").alias("r")).select("r.*")

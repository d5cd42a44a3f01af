"""Plans keep the shape they need at scale."""

import re

import pytest
from conftest import TESTDATA, plan_of

from wardline import context
from wardline.plans import registry, staging, star as star_plan
from wardline.plans.registry import all_queries
from wardline.plans.star import stored_star

QUERIES = all_queries()


def plan(spark, name):
    return plan_of(QUERIES[name](spark, TESTDATA))


@pytest.mark.parametrize(
    "name",
    [
        "stg_complaints", "stg_permits", "stg_inspections", "stg_arrests", "monthly_complaints",
        "monthly_arrests", "monthly_permits", "monthly_inspections", "mart_top_types",
        "mart_safety_full_outer", "mart_food_full_outer", "lag_join", "upsert_merge",
        "point_in_polygon", "point_in_polygon_shuffled", "orphan_keys",
        "fact_monthly", "zip_month_spine", "q17_grade_means", "q18_compliance_scatter",
    ],
)
def test_no_all_pairs_join_and_no_python(spark, name):
    text = plan(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert bad not in text


@pytest.mark.parametrize("name", ["stg_permits", "dedup_latest", "current_restaurants"])
def test_ranked_dedup_is_limited_before_the_shuffle(spark, name):
    tree = plan(spark, name).split("\n\n")[0]  # children below parents
    under = r"WindowGroupLimit(?:(?!Exchange).)*Exchange(?:(?!Exchange).)*WindowGroupLimit"
    assert re.search(under, tree, re.DOTALL)


def test_counts_are_combined_before_the_shuffle(spark):
    assert "partial_count" in plan(spark, "monthly_complaints")


def test_scans_read_needed_columns_only(spark):
    text = plan(spark, "mart_top_types")
    assert "l_shipdate" not in text  # the close date is not needed, so its join is gone
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz,o_orderpriority:string>" in text


def test_filters_reach_the_scan(spark):
    text = plan(spark, "q01_zip_month")
    assert "EqualTo(zip_code,NATION_7)" in text and "EqualTo(year_month,1998-05)" in text


@pytest.mark.parametrize("name", ["stg_permits", "stg_inspections"])
def test_text_is_made_after_the_dedup_shuffle(spark, name):
    """The rows that are ranked, and so sorted and shuffled, hold no raw text but the key's."""
    text = plan(spark, name)
    limits = re.findall(r"\(\d+\) WindowGroupLimit[^\n]*\nInput \[\d+\]: \[([^\n]*)\]", text)
    assert limits
    for columns in limits:
        assert "l_orderkey" in columns and not re.search("street|s_name|n_name|owner|violation_description", columns)


def test_stored_star_holds_no_raw_text(spark):
    star = stored_star(spark, TESTDATA)
    for name, table in (("permits", star.permit_rows), ("inspections", star.inspection_rows)):
        assert table.latest and set(table.rows.columns) <= set(star.table("lineitem").columns), name


def test_large_files_are_not_shuffled_before_the_text(spark, monkeypatch):
    assert "REBALANCE" in plan(spark, "stg_permits").upper()
    monkeypatch.setattr("wardline.plans.star.ONE_GROUP_BYTES", 0)
    assert "REBALANCE" not in plan(spark, "stg_permits").upper()


def held_at(spark, name, operator):
    """The columns that come into each operator of this kind."""
    return re.findall(rf"\(\d+\) {operator}[^\n]*\nInput \[\d+\]: \[([^\n]*)\]", plan(spark, name))


def test_permits_are_merged_before_their_text_is_made(spark):
    inputs = held_at(spark, "upsert_merge", "Exchange") + held_at(spark, "upsert_merge", "Sort")
    assert any("permit_sequence" in columns for columns in inputs)
    for columns in inputs:
        assert not re.search("owner_business|permittee|_source_file|street_name", columns)


def stored_columns(spark, monkeypatch, name):
    """The columns of every batch of rows that a query stores by key."""
    seen, real = [], registry.upsert.upsert

    def upsert(session, root, updates, *args, **kw):
        seen.append(set(updates.columns))
        return real(session, root, updates, *args, **kw)

    monkeypatch.setattr(registry.upsert, "upsert", upsert)
    QUERIES[name](spark, TESTDATA)
    return seen


NARROW = {*staging.PERMIT_ROW, "year_month", "moved"}


def test_upserted_permits_hold_no_raw_text(spark, monkeypatch):
    lines = set(spark.read.parquet(f"{TESTDATA}/lineitem.parquet").columns)
    seen = stored_columns(spark, monkeypatch, "upsert_stored")
    assert len(seen) == 2 and all(columns <= lines | NARROW for columns in seen)


def test_incremental_permits_hold_no_raw_text(spark, monkeypatch):
    lines = set(spark.read.parquet(f"{TESTDATA}/lineitem.parquet").columns)
    seen = stored_columns(spark, monkeypatch, "incremental_equals_full")
    assert len(seen) == 2 and all(columns <= lines | NARROW for columns in seen)


def test_lookback_ranks_narrow_rows(spark):
    ranked = held_at(spark, "lookback_recompute", "WindowGroupLimit")
    assert ranked and not any(re.search("job_type|permit_key|zip_code|expiration", columns) for columns in ranked)


def test_inspections_are_ranked_without_the_text_of_their_type(spark):
    text = plan(spark, "stg_inspections")
    ranked = re.findall(r"\(\d+\) WindowGroupLimit[^\n]*\nInput \[\d+\]: \[[^\n]*\]\nArguments: ([^\n]*)", text)
    assert ranked and "Re-inspection" in text
    typed = set(re.findall(r"THEN Re-inspection ELSE Initial END AS (inspection_type#\d+)", text))
    assert typed and not any(column in arguments for column in typed for arguments in ranked)


@pytest.mark.parametrize(("own", "seen"), [("128MB", 32 << 20), ("1g", 32 << 20), ("4m", 4 << 20), ("1000", 1000)])
def test_stored_tables_are_built_from_bounded_splits(spark, own, seen):
    """A task's sort holds as many rows of a large file as of a small one; the setting is handed back."""
    before = spark.conf.get(context.MAX_SPLIT)
    sizes = []

    def build(base):
        sizes.append(spark.conf.get(context.MAX_SPLIT))
        raise RuntimeError("stop")

    spark.conf.set(context.MAX_SPLIT, own)
    try:
        with pytest.raises(RuntimeError):
            star_plan._once(spark, f"probe-{own}", TESTDATA, build)
        assert sizes == [f"{seen}b"] and spark.conf.get(context.MAX_SPLIT) == own
    finally:
        spark.conf.set(context.MAX_SPLIT, before)


def test_checks_of_all_layers_read_stored_tables_only(spark):
    text = plan_of(registry._all_layers(stored_star(spark, TESTDATA)))
    assert "/permits_rows" in text and "/lineitem.parquet" not in text and "/orders.parquet" not in text


@pytest.mark.parametrize(
    ("name", "kind", "made_by"),
    [("scd2_history", "replay", "_replayed"), ("dq_all_layers", "checks", "_all_layers")],
)
def test_stored_results_are_built_from_bounded_splits(spark, monkeypatch, name, kind, made_by):
    seen = []

    def made(star):
        seen.append(spark.conf.get(context.MAX_SPLIT))
        return star.dates

    known = {k: v for k, v in star_plan._stored.items() if k[1] != kind}
    monkeypatch.setattr(star_plan, "_stored", known)
    monkeypatch.setattr(registry, made_by, made)
    tree = plan(spark, name).split("\n\n")[0]
    assert seen == [f"{32 << 20}b"] and "Exchange" not in tree and "WindowGroupLimit" not in tree

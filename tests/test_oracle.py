"""Every query against its SQL counterpart on the small tables."""

import sys
from pathlib import Path

import pytest
from conftest import TESTDATA

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from compare import compare, database  # noqa: E402

from oracle import oracle_queries  # noqa: E402
from wardline.plans.registry import all_queries  # noqa: E402

QUERIES = all_queries()
ORACLE = oracle_queries()


@pytest.fixture(scope="module")
def con():
    return database(TESTDATA)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    verdict, _, _ = compare(spark, con, TESTDATA, name, QUERIES[name], ORACLE.get(name))
    assert verdict.startswith(("ok", "rows only")), verdict


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    import __spark_entry__ as driver

    assert driver.queries().keys() >= QUERIES.keys()
    assert driver.oracle_sql().keys() >= ORACLE.keys()
    assert driver.entry(spark).columns == [
        "borough", "year_month", "complaint_type", "complaint_count", "borough_rank", "pct_of_borough_total",
    ]

"""A sample of the registered queries against their SQL; tests/check.py runs them all."""

import pytest

from quadrille.workload import QUERIES, SQL

from check import compare, connect

ROOT = "/root/testdata/sf0.001"
SAMPLE = [
    "quantile_trim", "kpi_price_by_subzone_year", "price_to_rent", "rent_summary", "indicator_risk", "safety_score",
    "comfort_score", "nearest_in_group", "assign_zone", "zone_ranking", "categorize_text", "table_fingerprint",
]


@pytest.fixture(scope="module")
def con():
    return connect(ROOT)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_agrees_with_sql(spark, con, name):
    assert compare(QUERIES[name](spark, ROOT), con, SQL[name]) == "ok"


def test_contract():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.FLAGSHIP in entry.queries()

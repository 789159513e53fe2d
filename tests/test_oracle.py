"""Every registered query against its DuckDB oracle SQL on the driver tables (exact
values, same column names, same row multiset)."""

import os

import pytest

import __spark_entry__ as E
from tempora.plans.catalog import REGISTRY
from scripts.check_oracle import compare, duck

SF = os.environ.get("TEMPORA_TEST_SF", "/root/testdata/sf0.001")
ORACLE = {k: sql for k, (_fn, sql) in REGISTRY.items()}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert all(ORACLE.values())
    assert set(REGISTRY) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, REGISTRY[name][0], ORACLE[name], SF)
    assert res["status"] == "MATCH", res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "total_retail_sales_yoy_growth_pct" in df.columns

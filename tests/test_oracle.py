"""Every registered query equals its DuckDB oracle at sf0.01 (the driver's gate)."""

from __future__ import annotations

import pytest

from citymarts.plans.catalog import QUERIES
from citymarts.plans.oracle import ORACLE
from conftest import SF_CHECK
from oracle_check import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_CHECK)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLE)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    ok, msg = compare(spark, key, SF_CHECK, con)
    assert ok, msg


def test_entry_smoke(spark):
    import __spark_entry__ as se
    df = se.entry(spark)
    assert df.columns == ["user_id", "act_city", "home_city", "travel_count", "travel_array",
                          "local_time"]
    assert df.count() > 0

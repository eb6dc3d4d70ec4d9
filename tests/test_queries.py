"""Every query of the engine against its SQL, and the driver's contract."""

from __future__ import annotations

import pytest

import __spark_entry__
from paceline.plans import registry

from .oracle import connection, same


@pytest.fixture(scope="module")
def con(sf):
    return connection(sf)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(name, spark, sf, con):
    same(registry.QUERIES[name](spark, sf), con, registry.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_query_without_sql_runs(name, spark, sf):
    df = registry.QUERIES[name](spark, sf)
    assert df.columns
    assert df.count() > 0


def test_contract(spark, sf):
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert set(registry.QUERIES) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["hourly_counts", "condition_filter"])
def test_filters_and_columns_reach_the_scan(name, spark, sf, capsys):
    plan = registry.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plan


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_no_cross_join_over_tables(name, spark, sf):
    """No plan multiplies two tables; what is broadcast against every row is one row or a fixed list."""
    plan = registry.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan

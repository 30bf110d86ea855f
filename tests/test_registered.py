"""Every registered query against its SQL counterpart."""

import compare
import pytest

import __spark_entry__ as driver
from stationlake.catalog import all_queries, all_sql


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_matches_sql(spark, sf_dir, con, name):
    query = driver.queries()[name]
    assert compare.differences(query(spark, sf_dir), con, driver.oracle_sql()[name]) == []


def test_every_query_of_the_catalog_has_sql():
    assert all_queries().keys() == all_sql().keys() <= driver.queries().keys()


def test_the_driver_contract_does_without_optional_parts(monkeypatch):
    monkeypatch.setattr(driver, "llm", None)
    assert driver.queries().keys() == all_queries().keys() and driver.oracle_sql() == all_sql()


def test_entry_has_rows_and_a_stable_schema(spark):
    first, second = driver.entry(spark), driver.entry(spark)
    assert first.schema == second.schema
    assert not first.isEmpty()


def test_the_shuffled_join_shuffles(spark, sf_dir):
    joined = driver.queries()["hourly_enrich_shuffled"](spark, sf_dir)
    joined.write.format("noop").mode("overwrite").save()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan

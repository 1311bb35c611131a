"""Every registered tree query against its SQL."""

import pytest

from skyshuffle import queries
from tests.oracle import same

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_agrees_with_sql(spark, name):
    same(queries.QUERIES[name](spark, SF), queries.ORACLES[name], SF)


def test_stored_tables_built_within_one_another_keep_apart(spark, monkeypatch):
    monkeypatch.setattr("skyshuffle.sources.store._STORED", {})  # as in an application that asks for nearest_meta first
    for name in ("nearest_meta", "nearest", "level_bands"):
        same(queries.QUERIES[name](spark, SF), queries.ORACLES[name], SF)


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_prefix_filter_is_pushed_down(spark):
    plan = queries.prefix_shard(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(morton_code" in plan


def test_shell_query_does_not_shuffle(spark):
    plan = queries.shell_query(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("name", ["shell_query", "radius_query", "nearest", "stats_rollup"])
def test_bounded_queries_push_ranges_to_the_scan(spark, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000000")
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().toString()
    assert any("GreaterThanOrEqual(morton_code" in line for line in plan.splitlines() if "PushedFilters" in line)

import pytest

from tests.oracle import compare
from trafficspark.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_its_sql(spark, sf_dir, name):
    compare(catalog.QUERIES[name](spark, sf_dir), catalog.ORACLE_SQL[name], sf_dir)


def test_entry_module(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).columns == ["hour_start", "flight_count", "hour_of_day", "day_of_week", "is_weekend", "lag_1h", "lag_24h", "rolling_mean_6h"]


def test_filter_reaches_the_scan(spark, sf_dir):
    from trafficspark.plans.fixtures import table

    plan = table(spark, sf_dir, "events").where("user_id = 3").select("event_id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(user_id), EqualTo(user_id,3)]" in plan and "ReadSchema: struct<event_id:bigint,user_id:bigint>" in plan


def test_windows_share_one_sort(spark, sf_dir):
    plan = catalog.QUERIES["hourly_features_by_key"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") <= 2

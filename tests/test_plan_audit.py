"""Every registered query plans without cartesian or nested-loop joins."""

import pytest

import __spark_entry__ as E
from tidecast.plans import catalog

# queries that run a stream or write a table while being built
SIDE_EFFECTS = {"bucketed_pack_series", "bucketed_forecast_points", "registry_append", "online_forecast_stream", "payload_capture", "stream_daily_series", "stream_context",
                "write_series_table", "csv_long_sink", "train_record_sink", "ensure_namespace", "drop_if_exists"}


@pytest.fixture(scope="module")
def no_aqe(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - SIDE_EFFECTS))
def test_no_cartesian_or_nested_loop(no_aqe, name):
    df = E.queries()[name](no_aqe, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan          # no row-at-a-time Python UDFs


def test_hot_id_facts_combine_before_the_exchange(no_aqe):
    # a third of all facts on one id: partial sums per task, exchange on (id, ds)
    plan = E.queries()["series_from_facts"](no_aqe, "/root/testdata/sf0.001")._jdf.queryExecution() \
        .executedPlan().treeString()
    ex = plan.index("Exchange hashpartitioning(unique_id")
    assert "partial_sum" in plan[ex:] and "ds#" in plan[ex:plan.index("\n", ex)]


def test_mixture_join_is_salted(no_aqe):
    plan = E.queries()["mixture_sample"](no_aqe, "/root/testdata/sf0.001")._jdf.queryExecution() \
        .executedPlan().treeString()
    joins = [ln for ln in plan.splitlines() if "Join" in ln and "_idx" in ln]
    assert joins and all("_salt" in ln for ln in joins)

"""Work that grows with the table is spread over tasks that do not."""

import datetime as dt

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidecast.operators import forecast as fc
from tidecast.operators import plugins as pl
from tidecast.operators import tablefunc as tf
from tidecast.operators import timeindex as ti
from tidecast.plans import catalog, series_sets
from tidecast.sources.synthetic import synth_series
from tidecast.streaming import scoring as sc
from tidecast.streaming import series as ss


@pytest.fixture
def lineitem(tmp_path):
    duckdb.sql(f"""COPY (SELECT k % 40 AS l_suppkey, DATE '2024-01-01' + CAST(k * 7 % 90 AS INTEGER) AS l_shipdate,
        CAST(k % 50 AS DOUBLE) AS l_quantity FROM range(2000) r(k)) TO '{tmp_path}/lineitem.parquet' (FORMAT parquet)""")
    return str(tmp_path)


def test_dense_sets_take_partitions_by_their_facts(spark, lineitem, monkeypatch):
    monkeypatch.setattr(series_sets, "TASK_FACTS", 100)
    d = series_sets.dense_set(spark, lineitem, "supplier_daily")
    assert d.rdd.getNumPartitions() == 20
    want = ti.densify(series_sets.series_set(spark, lineitem, "supplier_daily"))
    assert sorted(map(str, d.collect())) == sorted(map(str, want.collect()))
    # windows and arrays after it keep them: the only other exchange is the days' aggregate
    for name in ("impute_last_value", "token_table_test", "token_table_validation", "forecast_points_mean", "observed_filter"):
        plan = catalog.QUERIES[name](spark, lineitem)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("REPARTITION_BY_NUM") == 1 and plan.count("Exchange hashpartitioning") == 2, name


def test_synthetic_days_are_made_by_many_tasks(spark):
    ids = spark.range(40).select(F.col("id").cast("string").alias("unique_id")).coalesce(1)
    s = synth_series(ids, "2021-01-01", "2021-01-20", 7)
    used = s.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(used) > 1 and sum(r["count"] for r in used) == 800


def test_no_device_leaves_the_partitions_to_the_cluster(spark, series):
    rows = [(f"s{k}", f"2020-01-{i:02d}", float(i * k % 5)) for k in range(40) for i in range(1, 9)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")     # a table too large to coalesce
    try:
        p = fc.device_partition(series(rows), 0)
        assert p.rdd.getNumPartitions() == 8
        spread = p.withColumn("_p", F.spark_partition_id()).groupBy("unique_id").agg(F.countDistinct("_p").alias("n"))
        assert spread.where("n > 1").isEmpty()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_table_function_gets_the_context_alone(spark, lineitem):
    plan = catalog.QUERIES["forecast_table"](spark, lineitem)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("ArrowEvalPythonUDTF") < plan.index("WindowGroupLimit")
    name = tf.register_forecast_table(spark, pl.WindowMean(None), "ft_short", 3)
    got = spark.sql(f"SELECT * FROM {name}(TABLE({{t}}) PARTITION BY unique_id ORDER BY (ds), 2, 'D')", t=spark.createDataFrame(
        [("a", dt.datetime(2024, 1, d), float(d)) for d in range(1, 9)], "unique_id string, ds timestamp_ntz, y double")).collect()
    assert [(r.step, r.last_ds, r.yhat) for r in got] == [(k, dt.datetime(2024, 1, 8), 7.0) for k in (1, 2)]
    # rows may bring several points each
    runs = spark.createDataFrame([("a", dt.datetime(2024, 1, 8), [None, 6.0]), ("a", dt.datetime(2024, 1, 4), [9.0, 4.0]),
                                  ("b", dt.datetime(2024, 1, 1), [None]), ("b", dt.datetime(2024, 1, 2), None)],
                                 "unique_id string, ds timestamp_ntz, y array<double>")
    got = spark.sql(f"SELECT * FROM {name}(TABLE({{t}}) PARTITION BY unique_id ORDER BY (ds), 1, 'D')", t=runs).collect()
    assert sorted((r.unique_id, r.last_ds, r.yhat) for r in got) == [
        ("a", dt.datetime(2024, 1, 8), 5.0), ("b", dt.datetime(2024, 1, 2), None)]


def test_whole_series_go_to_a_client_in_bounded_batches(spark):
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    pl.forecast_struct_udf(pl.DriftClient, 2, context=None)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= pl.BATCH_BYTES


def test_split_requests_cast_their_times_once(spark):
    row = '{"dataframe_split": {"columns": ["value", "timestamp"], "index": [0, 1], "data": [[2.0, "2024-01-02 00:00:00"], ' \
          '[1.0, "2024-01-01 00:00:00"]]}, "params": {"h": 2}}'
    got = sc.score_requests(spark.createDataFrame([(row,)], "request string"), "drift")
    assert got.columns == ["request", "kind", "h", "predictions", "pred_ds", "reply", "error"]
    r = got.first()
    assert r.predictions == [[3.0, 4.0]] and r.pred_ds == [dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 4)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_max(") == 1


def test_a_context_is_summed_once_whatever_the_horizon(spark):
    from tidecast.streaming.registered import pooled_array_forecast
    x = spark.createDataFrame([([1.0, None, -3.0, float("nan")],), ([None],), ([],), (None,)], "c array<double>")
    got = x.select(pooled_array_forecast(F.col("c"), F.lit(2), F.lit(0.5), F.lit(1.0)).alias("f"))
    assert [r.f for r in got.collect()] == [[0.5, 2.25], None, None, None]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("aggregate(") <= 2


class _State:
    def __init__(self, got=None):
        self.exists, self.get = got is not None, got

    def update(self, new):
        self.exists, self.get = True, new


def test_context_merges_late_repeated_and_missing_points():
    day = lambda k: dt.datetime(2024, 1, k)
    frame = lambda *r: pd.DataFrame({"ds": pd.to_datetime([day(k) for k, _ in r]), "y": [v for _, v in r]})
    state, update = _State(), ss._context_updater(3)
    list(update(("a",), [frame((1, 1.0), (4, 4.0))], state))
    out, = update(("a",), [frame((3, 3.0), (4, None)), frame((2, np.nan), (3, 5.0))], state)
    assert out["context"][0] == [None, 5.0, None] and out["last_ds"][0] == day(4) and out["updates"][0] == 2
    assert state.get == ([day(2), day(3), day(4)], [None, 5.0, None], 2)

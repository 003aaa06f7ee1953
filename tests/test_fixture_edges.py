"""FIXTURES.md §C edge cases: empty, one point, all missing, NaN and NULL,
duplicates, shorter than / exactly the context, inverted ranges."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidecast.operators import aggregate as agg
from tidecast.operators import forecast as fc
from tidecast.operators import missing as ms
from tidecast.operators import sampling as sa
from tidecast.operators import splits as sp
from tidecast.operators import timeindex as ti
from tidecast.operators import tokens as tk
from tidecast.sources.facts import series_from_facts


def _empty(spark):
    return spark.createDataFrame([], "unique_id string, ds timestamp_ntz, y double")


def test_empty_table_flows_through(spark):
    e = _empty(spark)
    assert fc.forecast_points(e, "seasonal", "D", 5).count() == 0
    assert ti.densify(e).count() == 0
    assert sp.random_cut_split(e, 2, 2).count() == 0
    assert tk.token_table(e, context_length=4, prediction_length=2, min_past=2).count() == 0
    assert fc.forecast_samples(e, 3, 2).count() == 0
    assert agg.pack_series(e).count() == 0


def test_one_point_series(series):
    df = series([("a", "2020-01-01", 5.0)])
    got = fc.forecast_points(df, "drift", "D", 3).orderBy("step").collect()
    assert [r.yhat for r in got] == [5.0, 5.0, 5.0]
    for m in ("trend", "ar1", "seasonal", "mean", "last"):
        assert {r.yhat for r in fc.forecast_points(df, m, "D", 2).collect()} == {5.0}
    s = fc.forecast_samples(df, 3, 4, 1).collect()
    assert len(s) == 12 and {r.value for r in s} == {5.0}


def test_all_missing_series(series):
    df = series([("a", "2020-01-01", None), ("a", "2020-01-02", None)])
    r = fc.forecast_points(df, "mean", "D", 2).collect()
    assert len(r) == 2 and all(x.yhat is None for x in r)
    assert [x.y for x in ms.impute(df).collect()] == [0.0, 0.0]
    prof = agg.missing_profile(df).first()
    assert (prof.n, prof.n_missing, prof.missing_share) == (2, 2, 1.0)


def test_nan_and_null_in_facts_are_missing(spark):
    facts = spark.createDataFrame(
        [("a", dt.datetime(2020, 1, 1, 3), float("nan")), ("a", dt.datetime(2020, 1, 1, 9), 2.0),
         ("a", dt.datetime(2020, 1, 2), None), ("a", dt.datetime(2020, 1, 3), float("nan"))],
        "k string, t timestamp_ntz, v double")
    got = {r.ds.day: r.y for r in series_from_facts(facts, "k", "t", "v").collect()}
    assert got == {1: 2.0, 2: None, 3: None}


def test_duplicate_timestamps_do_not_invent_points(series):
    df = series([("a", "2020-01-01", 1.0), ("a", "2020-01-01", 2.0), ("a", "2020-01-03", 3.0)])
    d = ti.densify(df).collect()
    assert sorted(r.ds.day for r in d) == [1, 1, 2, 3]


def test_unsorted_input_and_time_of_day(series):
    df = series([("a", "2020-03-03 12:00:00", 3.0), ("a", "2020-03-01 12:00:00", 1.0),
                 ("a", "2020-03-02 12:00:00", 2.0)])
    r = fc.forecast_points(df, "last", "D", 1).first()
    assert r.yhat == 3.0 and r.ds == dt.datetime(2020, 3, 4, 12)


def test_context_shorter_and_exact(series):
    df = series([("a", f"2020-01-{d:02d}", float(d)) for d in range(1, 6)])
    cuts = df.sparkSession.createDataFrame([("a", 3)], "unique_id string, cut int")
    exact = sp.context_window(df, cuts, 3, 2).where("NOT is_future").collect()
    assert not any(r.is_pad for r in exact) and len(exact) == 3
    assert sp.context_window(df, cuts, 6, 2).where("is_pad").count() == 3


def test_inverted_ranges_give_nothing(spark, series):
    g = ti.date_grid(spark, "2020-02-01", "2020-01-01", "D")
    assert g.count() == 0
    df = sa.weight_repeat(series([("a", "2020-01-01", 1.0)]).withColumn("dataset", F.lit("x")), {"x": 0})
    assert df.count() == 0
    specs = sp.eval_grid(spark, "d", 0, 5, [10], [4], [2])   # eval_length < horizon -> 0 windows
    assert specs.first().windows == 0
    w = sp.rolling_eval_windows(series([("a", f"2020-01-{d:02d}", 1.0) for d in range(1, 30)]), specs, "d")
    assert w.count() == 0
    with pytest.raises(ValueError):
        fc.forecast_points(series([("a", "2020-01-01", 1.0)]), "last", "D", 0)


def test_request_with_bad_horizon(spark):
    from tidecast.streaming.scoring import score_requests
    df = spark.createDataFrame([("x", '{"dataframe_split": {"columns": ["timestamp", "value"], "index": [0],'
                                      ' "data": [["2020-01-01 00:00:00", 1.0]]}, "params": {"h": 0}}')],
                               "request_id string, request string")
    r = score_requests(df).first()
    assert r.reply is None and r.error == "horizon must be >= 1"


def test_ansi_mode_edges_do_not_fail_jobs(spark, series):
    # Spark 4 runs with ANSI on: a bad cell or an all-missing series must not fail the job
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = series([("a", "2020-01-01", None), ("b", "2020-01-01", 1.0)])
    got = {(r.unique_id, r.step): r.yhat for r in fc.forecast_points(df, "seasonal", "D", 2).collect()}
    assert got == {("a", 1): None, ("a", 2): None, ("b", 1): 1.0, ("b", 2): 1.0}
    from tidecast.streaming.scoring import score_requests
    reqs = [("v", '{"dataframe_split": {"columns": ["timestamp", "value"], "index": [0], '
                  '"data": [["2020-01-01 00:00:00", "abc"]]}}'),
            ("c", '{"dataframe_split": {"columns": ["ts", "v"], "index": [0], "data": [["2020-01-01", 1.0]]}}'),
            ("n", '{"inputs": [null, null]}')]
    r = {x.request_id: x for x in score_requests(
        spark.createDataFrame(reqs, "request_id string, request string")).collect()}
    assert r["v"].error == r["c"].error == "malformed dataframe_split"
    assert r["n"].kind == "inputs" and r["n"].error == "empty context"
    reg = spark.createDataFrame([("m", "3"), ("m", "x")], "name string, version string")
    assert agg.latest_version(reg, ["m"]).first().version == 3

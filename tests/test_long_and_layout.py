"""Segmented scans, bucketed and managed tables, the lag model, histogram packing, pushed ids and whole requests."""

import datetime as dt
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidecast.operators import aggregate as agg
from tidecast.operators import combine as cb
from tidecast.operators import forecast as fc
from tidecast.operators import lags as lg
from tidecast.operators import longscan as ls
from tidecast.operators import missing as ms
from tidecast.operators import patterns as pt
from tidecast.operators import sampling as sa
from tidecast.operators import select as sel
from tidecast.operators import splits as sp
from tidecast.operators import timeindex as ti
from tidecast.operators import tokens as tk
from tidecast.plans.requests import requests_from_series
from tidecast.plans.series_sets import long_series, series_set, table
from tidecast.sources import tables as tb
from tidecast.streaming import scoring as sc

SF = "/root/testdata/sf0.001"
SCHEMA = "unique_id string, ds timestamp_ntz, y double"


def bag(df):
    return sorted(map(str, df.collect()))


def points(spark, n=400, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for i, size in (("main", n), ("b", 7), ("c", 1), (None, 5)):
        for k in range(size):
            rows.append((i, dt.datetime(2020, 1, 1) + dt.timedelta(days=k), None if rng.random() < 0.3 else float(rng.integers(0, 50))))
    rows += [("gone", dt.datetime(2020, 1, k), None) for k in (1, 2, 3)]
    return spark.createDataFrame([rows[i] for i in rng.permutation(len(rows))], SCHEMA)


# ---------------------------------------------------------------- segmented scans
@pytest.mark.parametrize("parts", [1, 3, 40])
def test_long_operators_equal_the_window_path(spark, parts):
    df = points(spark)
    assert bag(ls.impute_long(df, parts)) == bag(ms.impute(df, "last").select("unique_id", "ds", "y"))
    assert bag(ls.rebase_daily_long(df, 50, partitions=parts)) == bag(ti.rebase_daily(df, 50))
    assert bag(ls.rebase_monthly_long(df, 50, partitions=parts)) == bag(ti.rebase_monthly(df, 50))
    for offset in (5, -4, 0):
        assert bag(ls.offset_split_long(df, offset, parts)) == bag(sp.offset_split(df, offset))
    for model in fc.BUILTINS:
        got = {(r.unique_id, r.step): (r.ds, r.yhat) for r in ls.forecast_points_long(df, model, "D", 4, partitions=parts).collect()}
        want = {(r.unique_id, r.step): (r.ds, r.yhat) for r in fc.forecast_points(df, model, "D", 4).collect()}
        assert got.keys() == want.keys()
        for k, (ds, y) in want.items():
            assert got[k][0] == ds and (got[k][1] == pytest.approx(y) if y is not None else got[k][1] is None)


def test_scan_columns_of_equal_points_and_empty_tables(spark):
    at = dt.datetime(2021, 1, 1)
    # one point repeated: a third of a table on one value must still be cut into chunks
    df = spark.createDataFrame([("a", at, 2.0)] * 300 + [("a", at, None)] * 3 + [("a", at + dt.timedelta(days=1), 1.0)], SCHEMA)
    rows = sorted(ls.segmented_scan(df, 16).collect(), key=lambda r: r.pos)
    assert [r.pos for r in rows] == list(range(304)) and {r.n for r in rows} == {304} and {r.n_obs for r in rows} == {301}
    assert [r.y for r in rows] == [None] * 3 + [2.0] * 300 + [1.0]
    assert [r.obs for r in rows] == [0] * 3 + list(range(1, 302))
    assert [r.lag_y for r in rows] == [None] * 4 + [2.0] * 300
    assert [r.filled for r in rows] == [2.0] * 303 + [1.0]
    assert [r.run_min for r in rows] == [None] * 3 + [2.0] * 300 + [1.0]
    assert rows[-1].run_sum == 601.0 and rows[-1].run_sumsq == 1201.0 and rows[0].run_sum == 0.0
    assert ls.segmented_scan(df.limit(0)).count() == 0 and ls.impute_long(df.limit(0)).count() == 0
    assert ls.forecast_points_long(df.limit(0)).count() == 0


def test_a_long_series_is_spread_over_tasks(spark):
    x = ls.segmented_scan(long_series(spark, SF), 12)
    main = x.where("unique_id = 'main'")
    assert main.count() > 0.8 * x.count()
    # chunks of the one series: its rows come from many partitions of the range exchange
    ranged = long_series(spark, SF).repartitionByRange(12, "unique_id", "ds").withColumn("p", F.spark_partition_id())
    per = [r["count"] for r in ranged.groupBy("p").count().collect()]
    assert len(per) >= 10 and max(per) < 0.3 * sum(per)


# ---------------------------------------------------------------- tables
def name_of(what):
    return f"tidecast_layout.{what}_{uuid.uuid4().hex[:8]}"


def test_bucketed_tables_are_read_without_an_exchange(spark):
    tb.ensure_namespace(spark, "tidecast_layout")
    s = series_set(spark, SF, "supplier_daily")
    name = name_of("bucketed")
    t = tb.write_bucketed_table(s, name, 6)
    assert bag(t) == bag(s)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for df in (agg.pack_series(t), fc.forecast_points(t, "trend"), ti.rebase_daily(t, 50), sp.holdout_split(t, 5),
                   t.join(agg.mean_abs_scale(t, ("unique_id",), False), "unique_id")):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "Exchange hashpartitioning" not in plan and "Bucketed: true" in plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert bag(agg.unpack_series(agg.pack_series(t))) == bag(s)
    assert tb.write_bucketed_table(s.limit(0), name_of("empty"), 3).count() == 0
    with pytest.raises(ValueError):
        tb.write_bucketed_table(s, name_of("none"), 0)
    tb.drop_if_exists(spark, name)


def exists(spark, path):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def test_dropping_a_table_frees_its_files_and_foreign_files_stay(spark):
    tb.ensure_namespace(spark, "tidecast_layout")
    s = series_set(spark, SF, "order_monthly")
    name = name_of("managed")
    tb.write_series_table(s, name)
    place = tb.default_location(spark, name)
    kind = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    assert kind["Type"] == "MANAGED" and exists(spark, place)
    tb.write_series_table(s.limit(3), name)                   # overwritten in its place
    assert spark.table(name).count() == 3
    tb.drop_if_exists(spark, name)
    assert not exists(spark, place)
    tb.drop_if_exists(spark, name)                            # a second time: nothing to do
    s.write.parquet(place)                                    # files that no table owns
    for write in (lambda: tb.write_series_table(s, name), lambda: tb.write_bucketed_table(s, name, 2)):
        with pytest.raises(ValueError, match="holds files of no table"):
            write()
    tb.drop_if_exists(spark, name)
    assert spark.read.parquet(place).count() == s.count()


# ---------------------------------------------------------------- ids pushed to the scan
def test_a_list_of_ids_reaches_the_scan(spark):
    s = series_set(spark, SF, "supplier_daily", ids=["1", "2", "03", "x", str(2**70), "2"])
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert "In(l_suppkey, [1,2])" in plan
    assert {r[0] for r in s.select("unique_id").distinct().collect()} == {"1", "2"}
    assert series_set(spark, SF, "supplier_daily", ids=[]).count() == 0
    assert {r[0] for r in series_set(spark, SF, "ship_daily", ids=["R", "?"]).select("unique_id").distinct().collect()} == {"R"}
    facts = table(spark, SF, "orders")
    assert sel.fact_ids(facts, "o_totalprice", ["nothing"]).count() == 0


# ---------------------------------------------------------------- the lag model
def test_lag_coefficients_equal_a_direct_solve(spark):
    s = series_set(spark, SF, "supplier_daily")
    for lags, ridge in (((1,), 0.0), ((1, 2, 7), 0.0), ((3, 1), 0.05)):
        rows, y = [], []
        for r in agg.pack_series(fc.last_points(s, 100)).collect():
            v = np.array(r.y, float)
            z = v / (np.abs(v).mean() or 1.0)
            for t in range(max(lags), len(z)):
                rows.append([1.0, *[z[t - k] for k in lags]])
                y.append(z[t])
        a, b = np.array(rows), np.array(y)
        penalty = np.diag([0.0] + [ridge * len(b)] * len(lags))
        want = np.linalg.solve(a.T @ a + penalty, a.T @ b)
        got = lg.pooled_lags_fit(s, lags, ridge, 100).first()
        assert got.n == len(b) and list(got.lags) == list(lags) and got.version == "1"
        assert np.allclose([got.intercept, *got.coef], want)


def test_lag_model_versions_scores_and_odd_series(spark):
    at = lambda k: dt.datetime(2022, 1, 1) + dt.timedelta(days=k)
    rows = [("a", at(k), float(k % 3)) for k in range(30)] + [("b", at(0), 5.0), ("c", at(0), None), ("z", at(0), 0.0), ("z", at(1), 0.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    first = lg.pooled_lags_fit(df, (3,), 0.0, 50, "m")
    again = lg.pooled_lags_fit(df, (1, 3), 0.0, 50, "m", registry=first.select("name", "version", "params"))
    both = first.select("name", "version", "params").unionByName(again.select("name", "version", "params"))
    out = lg.registry_score_lags(df, both, "m", 6, context=50).collect()
    assert {r.version for r in out} == {"2"} and len(out) == 4 * 6
    a = {r.step: r.yhat for r in out if r.unique_id == "a"}
    assert [round(a[k], 6) for k in range(1, 7)] == [0.0, 1.0, 2.0, 0.0, 1.0, 2.0]
    assert all(r.yhat is None for r in out if r.unique_id == "c")
    assert lg.registry_score_lags(df.limit(0), both, "m", 3).count() == 0
    none = lg.pooled_lags_fit(df.limit(0), (1, 2)).first()
    assert none.n == 0 and list(none.coef) == [0.0, 0.0]
    for bad in ((), (0,), (1, 1)):
        with pytest.raises(ValueError):
            lg.pooled_lags_fit(df, bad)


# ---------------------------------------------------------------- packing from a histogram
def check_bins(rows, top):
    by = {}
    for r in rows:
        by.setdefault(r.bin, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= top or len(parts) == 1
    return len(by)


def test_histogram_packing(spark):
    rng = np.random.default_rng(2)
    rows = [(f"k{i}", int(n)) for i, n in enumerate(rng.integers(1, 70, 2000))] + [("k0", 5), ("k0", 5), ("long", 900)]
    df = spark.createDataFrame(rows, "key string, length int")
    got = pt.pack_by_lengths(df.repartition(3), "key", "length", 64).collect()
    assert sorted((r.key, r.length) for r in got) == sorted(rows)
    bins = check_bins(got, 64)
    assert all(r.oversize == (r.length > 64) for r in got)
    over = sum(n > 64 for _, n in rows)
    best = -(-sum(n for _, n in rows if n <= 64) // 64) + over
    next_fit = sa.pack_sequences(df.withColumn("key", F.concat("key", F.lit("/"), F.monotonically_increasing_id())), "key", "length",
                                 shards=4, max_length=64).select("bin_id").distinct().count()
    assert best <= bins <= 1.03 * best < next_fit
    # neither partitions nor their number change a row's place, equal rows aside
    again = pt.pack_by_lengths(df.repartition(11, "length"), "key", "length", 64).collect()
    place = lambda rows: sorted((r.key, r.length, r.bin, r.offset) for r in rows)
    assert place(again) == place(got)


def test_histogram_packing_of_odd_tables(spark):
    empty = spark.createDataFrame([], "key string, length int")
    assert pt.pack_by_lengths(empty, "key", "length", 8).count() == 0
    one = pt.pack_by_lengths(spark.createDataFrame([(None, 8), ("a", 8), (None, 3)], empty.schema), "key", "length", 8).collect()
    assert check_bins(one, 8) == 3
    for bad in (0, -1, None):
        with pytest.raises(ValueError):
            pt.pack_by_lengths(spark.createDataFrame([("a", bad)], empty.schema), "key", "length", 8)
    counts = {1: 10, 3: 7, 5: 4, 9: 2}
    left = dict.fromkeys(counts, 0)
    for pattern, times in pt.bin_patterns(counts, 8):
        assert times > 0 and (sum(n * k for n, k in pattern.items()) <= 8 or pattern == {9: 1})
        for n, k in pattern.items():
            left[n] += k * times
    assert left == counts


# ---------------------------------------------------------------- arrays of windows, requests, skipped points
def test_array_windows_equal_the_long_path(spark):
    d = ti.densify(series_set(spark, SF, "supplier_daily"))
    for nonempty in (False, True):
        want = sp.context_window(d, sp.random_cut_split(d, 4, 2, 3.0, 11), 6, 2, nonempty=nonempty)
        assert bag(sp.random_windows(d, 4, 6, 2, 3.0, 11, nonempty)) == bag(want.select(
            "unique_id", "window_id", "forecast_start", "cut", "rel", "ds", "y", "is_pad", "is_future"))
    w = sp.context_window(d, sp.random_cut_split(d, 60, 10, 1.0, 3), 64, 10, nonempty=True)
    arrays = sp.window_arrays(sp.packed_cuts(sp.packed_points(d), 60, 10, 1.0, 3), 64, 10, nonempty=True)
    for kind in ("seq2seq", "causal"):
        cols = ["unique_id", "window_id", "scale", "forecast_start", "input_ids", "attention_mask", "labels"]
        assert bag(tk.tokenize_arrays(arrays, kind).select(*cols)) == bag(tk.tokenize_windows(w, kind).select(*cols))


def test_requests_hold_whole_series_and_batches_of_any_length(spark):
    at = lambda k: dt.datetime(2022, 1, 1) + dt.timedelta(days=k)
    df = spark.createDataFrame([("a", at(k), float(k)) for k in range(13)] + [("b", at(0), 1.0), ("b", at(1), 2.0)], SCHEMA)
    got = {r.request_id: r.request for r in requests_from_series(df).collect()}
    assert len(got) == 6
    import json
    assert json.loads(got["single:a"])["inputs"] == [float(k) for k in range(13)]
    batch = json.loads(got["batch:a"])["inputs"]
    assert len(batch) == 5 and sum(batch, []) == [float(k) for k in range(13)] and max(map(len, batch)) - min(map(len, batch)) <= 1
    assert json.loads(got["batch:b"])["inputs"] == [[1.0], [2.0]]
    assert len(json.loads(got["split:a"])["dataframe_split"]["data"]) == 13
    scored = sc.score_requests(requests_from_series(df), "last")
    assert scored.where("error IS NOT NULL").count() == 0
    assert requests_from_series(df.limit(0)).count() == 0


def test_points_without_a_likelihood_are_counted(spark):
    at = dt.datetime(2022, 1, 1)
    samples = spark.createDataFrame([("a", at, 1.0), ("a", at, 3.0), ("a", at + dt.timedelta(1), 2.0), ("a", at + dt.timedelta(1), 2.0),
                                     ("flat", at, 4.0), ("flat", at, 4.0), ("one", at, 4.0)], "unique_id string, ds timestamp_ntz, value double")
    actual = spark.createDataFrame([("a", at, 2.0), ("a", at + dt.timedelta(1), 2.0), ("flat", at, 4.0), ("one", at, 1.0)], SCHEMA)
    got = {r.unique_id: (r.n, r.n_skipped, r.nll is None) for r in cb.sample_nll(samples, actual).collect()}
    assert got == {"a": (1, 1, False), "flat": (0, 1, True), "one": (0, 1, True)}

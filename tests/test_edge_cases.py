"""Hand-made edge cases for the reference's quirks (Q1-Q19) and our invariants."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidecast.functions.calendar import check_freq
from tidecast.functions.positions import global_position
from tidecast.functions.tokens import token_id
from tidecast.operators import aggregate as agg
from tidecast.operators import forecast as fc
from tidecast.operators import missing as ms
from tidecast.operators import plugins as pl
from tidecast.operators import registry as rg
from tidecast.operators import sampling as sa
from tidecast.operators import select as sel
from tidecast.operators import splits as sp
from tidecast.operators import timeindex as ti
from tidecast.schema import SERIES_SCHEMA, conform_schema


def _rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.orderBy(*cols).collect()]


def test_month_end_steps_match_pandas(series):
    # Q9: mid-month -> same month end; month end -> next; leap day; time of day kept
    starts = ["2020-01-15", "2020-01-31", "2020-02-29", "2019-02-28", "2021-03-10 13:45:00", "2020-12-31 06:00:00"]
    df = series([(str(i), d, 1.0) for i, d in enumerate(starts)])
    got = ti.horizon_timestamps(df, "M", 4, as_="long").collect()
    got = {(r.unique_id, r.step): r.ds for r in got}
    for i, d in enumerate(starts):
        t = pd.Timestamp(d)
        for k in range(1, 5):
            t = t + pd.offsets.MonthEnd(1)
            assert got[(str(i), k)] == t.to_pydatetime(), (d, k)


def test_daily_steps_and_string_form(series):
    df = series([("a", "2020-02-27 10:00:00", 1.0)])
    r = ti.horizon_timestamps(df, "D", 3, as_="string").first()
    assert r.ds == ["2020-02-28 10:00:00", "2020-02-29 10:00:00", "2020-03-01 10:00:00"]


def test_freq_rejects_unknown_codes():
    # Q8: anything but D/M used to be silently daily
    with pytest.raises(ValueError):
        check_freq("W")


def test_id_range_daily_and_monthly():
    # Q1
    assert sel.id_range("D", 1, 4) == ["D1", "D2", "D3"]
    assert sel.id_range("M", 1, 3 + 1) == ["M1", "M2", "M3"]


def test_pack_keeps_order_and_null_alignment(series):
    # Q2: unsorted input, a NULL value keeps its slot
    df = series([("a", "2020-01-03", 3.0), ("a", "2020-01-01", 1.0), ("a", "2020-01-02", None)])
    p = agg.pack_series(df).first()
    assert p.y == [1.0, None, 3.0]
    assert [d.day for d in p.ds] == [1, 2, 3]


def test_rebase_daily_short_and_long(series):
    rows = [("a", f"2021-01-{d:02d}", float(d)) for d in range(1, 11)] + [("b", "2021-05-05", 7.0)]
    r = ti.rebase_daily(series(rows), keep=4, start="2020-01-01")
    got = _rows(r, "unique_id", "ds", "y")
    assert [g[2] for g in got if g[0] == "a"] == [7.0, 8.0, 9.0, 10.0]
    assert [g[1] for g in got if g[0] == "a"][0] == dt.datetime(2020, 1, 1)
    assert [g for g in got if g[0] == "b"] == [("b", dt.datetime(2020, 1, 1), 7.0)]


def test_rebase_monthly_shorter_than_keep(series):
    # Q5: shorter series keep their own length
    r = ti.rebase_monthly(series([("m", "2000-01-31", 1.0), ("m", "2000-02-29", 2.0)]), keep=60)
    assert [x.ds for x in r.orderBy("ds").collect()] == [dt.datetime(2018, 1, 31), dt.datetime(2018, 2, 28)]


def test_densify_fills_gaps_only_inside_span(series):
    df = series([("a", "2020-01-01", 1.0), ("a", "2020-01-04", 4.0), ("b", "2020-03-01", 5.0)])
    d = _rows(ti.densify(df), "unique_id", "ds", "y")
    assert [x[2] for x in d if x[0] == "a"] == [1.0, None, None, 4.0]
    assert len([x for x in d if x[0] == "b"]) == 1


def test_impute_leading_inner_trailing_and_all_missing(series):
    df = series([("a", "2020-01-01", None), ("a", "2020-01-02", 2.0), ("a", "2020-01-03", None),
                 ("a", "2020-01-04", 5.0), ("a", "2020-01-05", None), ("z", "2020-01-01", None)])
    got = _rows(ms.impute(df, "last"), "unique_id", "ds", "y")
    assert [g[2] for g in got if g[0] == "a"] == [2.0, 2.0, 2.0, 5.0, 5.0]
    assert [g[2] for g in got if g[0] == "z"] == [0.0]
    assert ms.impute(df, "leave") is df


def test_random_drop_is_deterministic_and_bounded(series):
    rows = [("a", (dt.date(2020, 1, 1) + dt.timedelta(days=i)).isoformat(), 1.0) for i in range(400)]
    df = series(rows)
    a = _rows(ms.random_drop(df, 0.2, 5), "ds", "y")
    b = _rows(ms.random_drop(df.repartition(7), 0.2, 5), "ds", "y")
    assert a == b
    share = sum(1 for x in a if x[1] is None) / len(a)
    assert share <= 0.3


def test_fixed_context_right_pad_and_exact(series):
    df = series([("s", f"2020-01-{d:02d}", float(d)) for d in range(1, 4)])
    r = sp.fixed_context(agg.pack_series(df), 5).first()
    assert r.context == [1.0, 2.0, 3.0, 0.0, 0.0] and r.mask == [1, 1, 1, 0, 0]
    r = sp.fixed_context(agg.pack_series(df), 3).first()
    assert r.context == [1.0, 2.0, 3.0] and r.mask == [1, 1, 1]
    r = sp.fixed_context(agg.pack_series(df), 2).first()
    assert r.context == [2.0, 3.0]


def test_context_window_left_pads(series):
    df = series([("s", f"2020-01-{d:02d}", float(d)) for d in range(1, 8)])
    cuts = df.sparkSession.createDataFrame([("s", 2)], "unique_id string, cut int")
    w = sp.context_window(df, cuts, 4, 2).orderBy("rel").collect()
    assert [x.rel for x in w] == [-4, -3, -2, -1, 0, 1]
    assert [x.is_pad for x in w] == [True, True, False, False, False, False]
    assert [x.y for x in w] == [None, None, 1.0, 2.0, 3.0, 4.0]


def test_random_cut_split_keeps_at_least_one(series):
    rows = [(k, (dt.date(2020, 1, 1) + dt.timedelta(days=i)).isoformat(), float(i))
            for k in "abcd" for i in range(30)]
    cuts = sp.random_cut_split(series(rows), min_past=5, h=3, num_instances=0.01, seed=1)
    per = {r.unique_id: r["count"] for r in cuts.groupBy("unique_id").count().collect()}
    assert set(per) == set("abcd")
    assert all(5 <= r.cut <= 27 for r in cuts.collect())


def test_sample_median_is_exact(spark):
    df = spark.createDataFrame([("a", 1, float(v)) for v in (1, 2, 3, 10)], "unique_id string, step int, value double")
    assert agg.sample_median(df).first().median == 2.5


def test_latest_version_default_and_exists(spark):
    reg = spark.createDataFrame([("m", "2"), ("m", "10"), ("m", "9")], "name string, version string")
    got = {r.name: (r.version, r.exists) for r in agg.latest_version(reg, ["m", "absent"]).collect()}
    assert got == {"m": (10, True), "absent": (1, False)}   # Q13


def test_runs_empty_and_nonempty(spark):
    empty = spark.createDataFrame([], "path string")
    assert agg.latest_run(empty).first().latest_run is None
    assert agg.next_run(empty).first().next_path == "run-0"
    lst = spark.createDataFrame([("run-0",), ("run-7",), ("run-x",), ("logs",), ("a/run-3",)], "path string")
    assert agg.latest_run(lst).first().latest_run == 7
    assert agg.next_run(lst, base_dir="/out").first().next_path == "/out/run-8"


def test_early_stopping_curve(spark):
    vals = [5.0, 4.0, 4.5, 3.0, 3.5, 3.2, 3.1, 2.0]
    m = spark.createDataFrame([("r", e, "loss", v) for e, v in enumerate(vals)],
                              "run string, epoch int, metric string, value double")
    r = agg.early_stop_epoch(m, patience=3, monitor="loss").first()
    assert (r.stop_epoch, r.best_epoch, r.best_value) == (6, 3, 3.0)
    # min_delta > 0: best only moves on a gain larger than 0.6 -> 5.0, 4.0, 3.0; stop after 3 misses
    r2 = agg.early_stop_epoch(m, patience=2, min_delta=0.6, monitor="loss").first()
    assert (r2.stop_epoch, r2.best_epoch, r2.best_value) == (5, 3, 3.0)
    with pytest.raises(ValueError):
        agg.early_stop_epoch(m, min_delta=-1.0, monitor="loss")
    b = agg.best_checkpoint(m, "loss", "min", 2).orderBy("rank").collect()
    assert [x.epoch for x in b] == [7, 3]


def test_conform_schema_raises_on_missing(spark):
    df = spark.createDataFrame([("a", 1.0)], "unique_id string, y double")
    with pytest.raises(ValueError):
        conform_schema(df, SERIES_SCHEMA)


def test_global_position_matches_sort_for_any_partitioning(spark):
    df = spark.range(2000).select(F.md5(F.col("id").cast("string")).alias("k"))
    expected = sorted(r.k for r in df.collect())
    for n in (1, 3, 16):
        got = global_position(df.repartition(5), ["k"], num_partitions=n).orderBy("position").collect()
        assert [r.k for r in got] == expected
        assert [r.position for r in got] == list(range(2000))


def test_shard_assign_equal_shards(spark):
    df = sa.global_shuffle(spark.range(10).select(F.col("id").cast("string").alias("unique_id")), 3)
    s = sa.shard_assign(df, 4).collect()
    sizes = pd.Series([r["rank"] for r in s]).value_counts()
    assert len(s) == 12 and set(sizes) == {3}
    assert len(sa.shard_assign(df, 4, drop_last=True).collect()) == 8


def test_pack_sequences_invariants(spark):
    rng = np.random.default_rng(0)
    rows = [(f"s{i}", int(x)) for i, x in enumerate(rng.integers(1, 200, 500))] + [("big", 700)]
    df = spark.createDataFrame(rows, "k string, length long")
    out = sa.pack_sequences(df, "k", "length", max_length=512, shards=4).toPandas()
    assert sorted(out["key"]) == sorted(r[0] for r in rows)
    fill = out.groupby("bin_id")["length"].sum()
    multi = out.groupby("bin_id").size()
    assert all((fill <= 512) | (multi == 1))
    assert (out["offset"] + out["length"] <= np.maximum(512, out["length"])).all()


def test_forecast_udf_survives_many_arrow_batches(spark, series):
    # Q6: one output batch per input batch, also with 2 rows per Arrow batch
    rows = [(f"s{k}", (dt.date(2020, 1, 1) + dt.timedelta(days=i)).isoformat(), float(i % 7 + k))
            for k in range(9) for i in range(20)]
    packed = agg.pack_series(series(rows)).coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        u = pl.forecast_udf(pl.SeasonalNaive(7), h=3, num_samples=2, batch_size=4)
        got = {r.unique_id: r.f for r in packed.select("unique_id", u("y").alias("f")).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    native = fc.forecast_points(series(rows), "seasonal", "D", 3).collect()
    for r in native:
        assert got[r.unique_id][r.step - 1] == r.yhat


def test_device_partition_zero_and_results_unchanged(series):
    # Q10: zero devices -> one partition, results identical
    rows = [(k, (dt.date(2020, 1, 1) + dt.timedelta(days=i)).isoformat(), float(i * (ord(k) % 5)))
            for k in "abcdef" for i in range(15)]
    df = series(rows)
    base = _rows(fc.forecast_points(df, "drift", "D", 4), "unique_id", "step", "yhat")
    for n in (0, 1, 4):
        p = fc.device_partition(df, n)
        assert p.rdd.getNumPartitions() == max(1, n)
        assert _rows(fc.forecast_points(p, "drift", "D", 4), "unique_id", "step", "yhat") == base


def test_same_result_for_1_4_64_shuffle_partitions(spark, series):
    rows = [(k, (dt.date(2020, 1, 1) + dt.timedelta(days=i)).isoformat(), float((i * 7) % 11))
            for k in "abc" for i in range(40)]
    out = []
    for n in (1, 4, 64):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        out.append(_rows(fc.forecast_samples(series(rows), 5, 4, 2), "unique_id", "sample", "step", "value"))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert out[0] == out[1] == out[2]


def test_token_ids_equal_bucket_search(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0, 6, 20000), [-15.0, 15.0, -40.0, 40.0, 0.0]])
    centers = np.linspace(-15, 15, 4093)
    bounds = np.concatenate([[-1e20], (centers[1:] + centers[:-1]) / 2, [1e20]])
    expected = np.searchsorted(bounds, x, side="right") + 2
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    got = np.array([r.t for r in df.select(token_id(F.col("v")).alias("t")).collect()])
    assert (got == expected).mean() > 0.9999
    assert got.min() >= 3 and got.max() <= 4095


def test_score_requests_shapes_and_errors(spark):
    reqs = [("a", '{"inputs": [1, 2, 3, 4, 5, 6, 7, 8]}'),
            ("b", '{"inputs": [[1, 2, 3], [4, 5]]}'),
            ("c", '{"dataframe_split": {"columns": ["timestamp", "value"], "index": [0, 1],'
                  ' "data": [["2020-01-01 00:00:00", 1.5], ["2020-01-02 00:00:00", 2.5]]}, "params": {"h": 3}}'),
            ("d", '{"dataframe_split": {"columns": ["timestamp", "value"], "index": [0],'
                  ' "data": [["2020-01-01 00:00:00", 4.0]]}}'),
            ("e", "not json"), ("f", '{"inputs": []}')]
    from tidecast.streaming.scoring import score_requests
    df = spark.createDataFrame(reqs, "request_id string, request string")
    got = {r.request_id: r for r in score_requests(df).collect()}
    assert got["a"].kind == "inputs" and got["a"].h == 10 and got["a"].predictions[0][:7] == [2, 3, 4, 5, 6, 7, 8]
    assert got["b"].kind == "inputs_batch" and got["b"].predictions[1][:2] == [4.0, 5.0]
    assert got["c"].h == 3 and got["c"].predictions[0] == [1.5, 2.5, 1.5]
    assert got["c"].pred_ds[0] == dt.datetime(2020, 1, 3)
    assert got["d"].h == 12
    assert got["e"].error == "malformed request" and got["e"].reply is None
    assert got["f"].error is not None


def test_stream_context_equals_batch_tail(spark, series):
    import uuid
    from tidecast.session import scratch_path
    from tidecast.streaming.series import stream_context
    rows = [(k, (dt.date(2020, 1, 1) + dt.timedelta(days=i)).isoformat(), float(i))
            for k in "ab" for i in range(50)]
    df = series(rows)
    d = scratch_path(spark, "ctx-test")
    df.repartition(5).write.parquet(d)
    src = spark.readStream.schema("unique_id string, ds timestamp_ntz, y double").option(
        "maxFilesPerTrigger", 1).parquet(d)
    q = (stream_context(src, 8).writeStream.format("memory").queryName(f"ctx_{uuid.uuid4().hex[:6]}")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    res = spark.table(q.name)
    last = {r.unique_id: r.context for r in res.groupBy("unique_id").agg(
        F.max_by("context", "updates").alias("context")).collect()}
    assert last == {"a": [float(i) for i in range(42, 50)], "b": [float(i) for i in range(42, 50)]}


def test_plan_context_window_is_equi_join(spark, series):
    df = series([("s", f"2020-01-{d:02d}", float(d)) for d in range(1, 20)])
    cuts = sp.random_cut_split(df, 3, 2, 2.0, 1)
    plan = sp.context_window(df, cuts, 4, 2)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_plan_global_shuffle_has_no_single_partition_window(spark):
    # the only single-partition exchange sits above the per-partition counts
    # (one row per partition), never above the data itself
    df = spark.range(100).select(F.col("id").cast("string").alias("unique_id"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lines = sa.global_shuffle(df, 1)._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert any("Scan ExistingRDD" in ln for ln in lines)      # the range-partitioned rows, written once
    singles = [i for i, ln in enumerate(lines) if "Exchange SinglePartition" in ln]
    assert singles
    for i in singles:
        assert "HashAggregate(keys=[_part" in lines[i + 1], lines[i:i + 3]


def test_plan_forecast_long_table_single_exchange(spark, tmp_path_factory):
    from tidecast.session import scratch_path
    from tidecast.sources.tables import scan_series
    p = scratch_path(spark, "long")
    rows = [(k, dt.datetime(2020, 1, 1) + dt.timedelta(days=i), float(i)) for k in "ab" for i in range(30)]
    spark.createDataFrame(rows, "unique_id string, ds timestamp_ntz, y double").write.parquet(p)
    df = fc.forecast_points(scan_series(spark, p), "seasonal", "D", 5)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 1, plan
    assert "ReadSchema: struct<unique_id:string,ds:timestamp_ntz,y:double>" in plan


def test_plan_series_predicate_reaches_scan(spark):
    import __spark_entry__ as E
    df = E.queries()["select_series"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_returnflag,R)" in plan


def test_sample_ids_paths_agree(spark, series):
    rows = [(str(k), f"2020-01-0{d}", float(k * d)) for k in range(30) for d in range(1, 4)]
    df = series(rows)
    want = sorted(map(tuple, df.where(F.col("unique_id").isin(["1", "5", "7"])).collect()))
    assert sorted(map(tuple, sel.sample_series_ids(df, [1, 5, 7]).collect())) == want
    ids = df.sparkSession.createDataFrame([(1,), (5,), (7,)], "k long")
    assert sorted(map(tuple, sel.sample_series_ids(df, ids).collect())) == want


def test_positions_hold_with_payload_columns(spark):
    # enough rows that range bounds are sampled; the whole output is written, payload included
    import uuid

    from tidecast.functions.positions import global_position
    from tidecast.session import scratch_path
    n = 2_000_000
    df = spark.range(n).select(F.md5(F.col("id").cast("string")).alias("k"), F.repeat(F.lit("x"), 20).alias("a"), (F.col("id") * 3).alias("b"))
    path = scratch_path(spark, f"positions-{uuid.uuid4().hex[:6]}")
    global_position(df, ["k"], "position", 16).write.parquet(path)
    got = spark.read.parquet(path)
    r = got.agg(F.count_distinct("position"), F.min("position"), F.max("position"), F.count_if(F.col("b").isNull())).first()
    assert tuple(r) == (n, 0, n - 1, 0)
    from pyspark.sql import Window
    steps = got.withColumn("_b", F.floor(F.col("position") / 1000))
    bad = steps.withColumn("_p", F.lag("k").over(Window.partitionBy("_b").orderBy("position"))).where("_p > k")
    assert bad.isEmpty()


def test_foreign_folders_survive(spark):
    from tidecast.sources import tables as tb
    jvm = spark.sparkContext._jvm
    wh = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    p = jvm.org.apache.hadoop.fs.Path(f"{wh}/foreign_tbl_payload/file.txt")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.create(p, True).close()
    tb.drop_if_exists(spark, "foreign_tbl_payload")
    with pytest.raises(ValueError, match="holds files of no table"):
        tb.write_series_table(spark.range(3).select(F.col("id").cast("string").alias("unique_id")), "foreign_tbl_payload")
    assert fs.exists(p) and not spark.catalog.tableExists("foreign_tbl_payload")
    tb.drop_if_exists(spark, "foreign_tbl_payload")
    assert fs.exists(p)


def test_unsorted_requests_freq_and_plugin(spark):
    from tidecast.streaming.scoring import parse_replies, score_requests
    body = ('{"dataframe_split": {"columns": ["timestamp", "value"], "index": [0, 1, 2], "data": [["2020-01-03 00:00:00", 30.0],'
            ' ["2020-01-01 00:00:00", 10.0], ["2020-01-02 00:00:00", 20.0]]}, "params": {"h": 2%s}}')
    df = spark.createDataFrame([("abc", body % ""), ("x2", body % ', "freq": "M", "finetune_steps": 3'), ("q", body % ', "freq": "W"'),
                                ("z", '{"inputs": [[1, 2], [3]]}')], "request_id string, request string")
    got = {r.request_id: r for r in score_requests(df, "last").collect()}
    assert got["abc"].predictions == [[30.0, 30.0]] and got["q"].error == "malformed dataframe_split"
    assert [t.day for t in got["x2"].pred_ds] == [31, 29] and [t.day for t in got["abc"].pred_ds] == [4, 5]
    back = parse_replies(score_requests(df, "last")).groupBy("request_id").count().collect()
    assert {r.request_id: r["count"] for r in back} == {"abc": 2, "x2": 2, "z": 20}

    plug = {r.request_id: r for r in score_requests(df, pl.Drift()).collect()}
    assert plug["abc"].predictions == [[40.0, 50.0]] and plug["z"].predictions[1] == [3.0] * 10 and plug["q"].reply is None


def test_plugin_is_set_up_once_per_task(spark, series):
    class CountingMean(pl.Forecaster):
        def setup(self):
            self.calls = getattr(self, "calls", 0) + 1

        def predict(self, contexts, h, num_samples):
            import numpy as np
            return np.full((len(contexts), num_samples, h), float(self.calls))

    rows = [(f"s{k}", f"2020-01-0{d}", 1.0) for k in range(60) for d in (1, 2)]
    out = pl.forecast_long(series(rows), CountingMean(), "D", 1, context=5).collect()
    assert len(out) == 60 and {r.yhat for r in out} == {1.0}


def test_pack_sequences_does_not_depend_on_partitions(spark):
    df = spark.range(500).select(F.col("id").alias("k"), (F.col("id") % 97 + 1).alias("length"))
    out = []
    for n in (8, 32):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        out.append(sorted(map(tuple, sa.pack_sequences(df, "k", "length", shards=5, max_length=64).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert out[0] == out[1] and any(r[-1] for r in out[0])


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from tidecast.session import ensure_checkpoint_dir
    conf = SimpleNamespace(get=lambda key, default=None: default)
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://host"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            ensure_checkpoint_dir(SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master)))


def test_registry_append_keeps_what_is_stored(spark):
    from tidecast.sources import tables as tb
    tb.drop_if_exists(spark, "append_registry")
    rows = spark.createDataFrame([("m", "1", '{"slope":0.5,"intercept":1.25,"n":7,"context":null}')], "name string, version string, params string")
    rg.registry_append(rows, "append_registry")
    got = rg.registry_append(rows.withColumn("version", F.lit("2")), "append_registry")
    assert sorted((r.version, r.slope, r.intercept, r.n) for r in got.collect()) == [("1", 0.5, 1.25, 7), ("2", 0.5, 1.25, 7)]
    tb.drop_if_exists(spark, "append_registry")

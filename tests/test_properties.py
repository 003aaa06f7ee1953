"""Property tests and invariants: calendar vs pandas, partition independence,
streaming sink equals batch, sink round trips."""

import datetime as dt

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidecast.operators import combine as cb
from tidecast.operators import sampling as sa
from tidecast.operators import splits as sp
from tidecast.operators import timeindex as ti
from tidecast.session import scratch_path

stamps = st.datetimes(min_value=dt.datetime(1990, 1, 1), max_value=dt.datetime(2035, 12, 31))


@settings(max_examples=25, deadline=None)
@given(st.lists(stamps, min_size=1, max_size=6, unique=True))
def test_month_end_steps_equal_pandas(spark, ts):
    ts = [t.replace(microsecond=0) for t in ts]
    df = spark.createDataFrame([(str(i), t, 1.0) for i, t in enumerate(ts)],
                               "unique_id string, ds timestamp_ntz, y double")
    got = {(r.unique_id, r.step): r.ds for r in ti.horizon_timestamps(df, "M", 3, as_="long").collect()}
    for i, t in enumerate(ts):
        cur = pd.Timestamp(t)
        for k in (1, 2, 3):
            cur = cur + pd.offsets.MonthEnd(1)
            assert got[(str(i), k)] == cur.to_pydatetime()


def _daily(spark, n_series=6, days=60):
    rows = [(f"s{k}", dt.datetime(2021, 1, 1) + dt.timedelta(days=i), float((i * (k + 3)) % 17))
            for k in range(n_series) for i in range(days)]
    return spark.createDataFrame(rows, "unique_id string, ds timestamp_ntz, y double")


@pytest.mark.parametrize("op", ["cuts", "shuffle", "mixture"])
def test_random_operators_ignore_partitioning(spark, op):
    out = []
    for n in (1, 4, 64):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        df = _daily(spark).repartition(n)
        if op == "cuts":
            res = sp.random_cut_split(df, 5, 3, 2.0, 9).select("unique_id", "cut")
        elif op == "shuffle":
            res = sa.global_shuffle(df.select("unique_id").distinct(), 4)
        else:
            d = cb.concat_datasets({"a": df, "b": df.withColumn("unique_id", F.concat(F.lit("b"), "unique_id"))})
            res = sa.mixture_sample(d, {"a": 0.7, "b": 0.3}, 200, 5)
        out.append(sorted(tuple(r) for r in res.collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert out[0] == out[1] == out[2]


def test_mixture_follows_probabilities(spark):
    df = _daily(spark, n_series=4, days=3)
    d = cb.concat_datasets({"a": df, "b": df.withColumn("unique_id", F.concat(F.lit("b"), "unique_id"))})
    res = sa.mixture_sample(d, {"a": 0.9, "b": 0.1}, 5000, 1).groupBy("dataset").count().collect()
    share = {r.dataset: r["count"] / 5000 for r in res}
    assert abs(share["a"] - 0.9) < 0.03


def test_stream_daily_series_equals_batch_for_closed_days(spark):
    from tidecast.streaming.series import stream_daily_series
    sf = "/root/testdata/sf0.001"
    ev = spark.read.parquet(f"{sf}/events.parquet")
    src = spark.readStream.schema(ev.schema).option("basePath", sf).parquet(f"{sf}/events.parq*")
    out, ck = scratch_path(spark, "sds"), scratch_path(spark, "sds-ck")
    q = (stream_daily_series(src, "1 day").writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", ck).trigger(availableNow=True).start(out))
    q.awaitTermination()
    streamed = {(r.unique_id, r.ds): round(r.y, 6) for r in spark.read.parquet(out).collect()}
    from tidecast.sources.facts import series_from_facts
    batch = series_from_facts(ev, "event_type", "ts", "value")
    wm = ev.agg(F.max("ts")).first()[0] - dt.timedelta(days=1)
    closed = {(r.unique_id, r.ds): round(r.y, 6) for r in batch.collect() if r.ds + dt.timedelta(days=1) <= wm}
    assert streamed == closed and len(closed) > 0


def test_event_time_ignores_session_zone(spark):
    from tidecast.streaming.series import wall_clock_instant
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23, 30, 0, 123456),)], "t timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        micros = df.select(F.unix_micros(wall_clock_instant(F.col("t")))).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    exp = int((dt.datetime(2024, 1, 1, 23, 30, 0, 123456) - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1))
    assert micros == exp


def test_csv_and_record_round_trips(spark):
    from tidecast.operators.aggregate import pack_series
    from tidecast.sources import files as fl
    df = _daily(spark, 3, 10).withColumn("y", F.when(F.col("y") == 0, None).otherwise(F.col("y") / 3))
    p = scratch_path(spark, "csv")
    fl.csv_long_sink(df, p)
    back = fl.csv_long_scan(spark, p)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    r = scratch_path(spark, "rec")
    fl.train_record_sink(pack_series(df), r)
    rec = {x.unique_id: x for x in fl.train_record_scan(spark, r, "D").collect()}
    assert rec["s0"].start == dt.datetime(2021, 1, 1) and rec["s0"].freq == "D" and len(rec["s0"].target) == 10


def test_write_series_table_partitioned(spark):
    from tidecast.sources import tables as tb
    tb.ensure_namespace(spark, "tidecast_test")
    df = _daily(spark, 3, 70).withColumn("month", F.date_format("ds", "yyyy-MM"))
    back = tb.write_series_table(df, "tidecast_test.daily", partition_by=["month"])
    assert back.count() == 210
    assert back.where("month = '2021-02'").count() == 3 * 28
    tb.drop_if_exists(spark, "tidecast_test.daily")
    assert not spark.catalog.tableExists("tidecast_test.daily")


def test_synth_series_is_standard_normal(spark):
    from tidecast.sources.synthetic import synth_series
    ids = spark.range(50).select(F.col("id").cast("string").alias("unique_id"))
    s = synth_series(ids, "2021-01-01", "2021-12-31", 7).agg(F.avg("y").alias("m"), F.stddev("y").alias("s")).first()
    assert abs(s.m) < 0.05 and abs(s.s - 1) < 0.05


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_global_position_consistent_when_range_sampling_is_partial(spark, reuse):
    # 300k rows in 6 input partitions: the range partitioner samples a subset,
    # so counts and rows must come from one partitioning
    from tidecast.functions.positions import global_position
    df = spark.range(300000).repartition(6).select(F.md5(F.col("id").cast("string")).alias("k"))
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        g = global_position(df, ["k"], num_partitions=16)
        r = g.agg(F.count("*").alias("n"), F.countDistinct("position").alias("d"),
                  F.min("position").alias("lo"), F.max("position").alias("hi")).first()
        first = g.orderBy("position").limit(3).collect()
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")
    assert (r.n, r.d, r.lo, r.hi) == (300000, 300000, 0, 299999)
    assert [x.k for x in first] == sorted(x.k for x in df.orderBy("k").limit(3).collect())


def test_payload_capture_is_exactly_once_across_restarts(spark):
    import uuid
    from tidecast.sources.tables import drop_if_exists
    from tidecast.streaming.scoring import REQUEST_FILE_SCHEMA, payload_capture, score_requests
    in_dir, ck = scratch_path(spark, "req"), scratch_path(spark, "req-ck")
    table = f"payload_{uuid.uuid4().hex[:8]}"
    drop_if_exists(spark, table)
    mk = lambda ids: spark.createDataFrame(
        [(f"r{i}", '{"inputs": [1, 2, 3, 4]}') for i in ids], "request_id string, request string")
    mk(range(5)).write.mode("append").json(in_dir)

    def run():
        src = spark.readStream.schema(REQUEST_FILE_SCHEMA).json(in_dir)
        payload_capture(score_requests(src), table, ck).awaitTermination()
        return sorted(r.request_id for r in spark.table(table).collect())

    assert run() == [f"r{i}" for i in range(5)]
    assert run() == [f"r{i}" for i in range(5)]          # restart: nothing re-delivered
    mk(range(5, 8)).write.mode("append").json(in_dir)
    assert run() == sorted(f"r{i}" for i in range(8))   # only the new file is added
    drop_if_exists(spark, table)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.lists(st.floats(min_value=1.0, max_value=100.0), min_size=1, max_size=12), min_size=1, max_size=4),
       st.integers(min_value=1, max_value=4))
def test_early_stop_fold_equals_windows(spark, curves, patience):
    from tidecast.operators.aggregate import early_stop_epoch
    rows = [(f"r{i}", e, "loss", float(v)) for i, c in enumerate(curves) for e, v in enumerate(c)]
    m = spark.createDataFrame(rows, "run string, epoch int, metric string, value double")
    native = sorted(tuple(r) for r in early_stop_epoch(m, patience, 0.0).collect())
    # a delta below one ulp of values >= 1 changes nothing, but takes the sequential-fold path
    fold = sorted(tuple(r) for r in early_stop_epoch(m, patience, 1e-300).collect())
    assert native == fold


def test_stream_daily_series_drops_rows_behind_the_watermark(spark):
    # Spark drops a row as late when it is older than the watermark the previous
    # micro-batch evicted with; three files -> three batches make that visible
    import time as _t
    from tidecast.streaming.series import stream_daily_series
    schema = "event_type string, ts timestamp_ntz, value double"
    in_dir, out, ck = scratch_path(spark, "late-in"), scratch_path(spark, "late-out"), scratch_path(spark, "late-ck")
    files = [[("a", dt.datetime(2024, 1, d, 12), 1.0) for d in range(1, 11)],
             [("a", dt.datetime(2024, 1, 11, 12), 1.0)],
             [("a", dt.datetime(2024, 1, 2, 9), 100.0),    # behind Jan 9 12:00: dropped
              ("a", dt.datetime(2024, 1, 9, 18), 5.0)]]    # Jan 9 is still open: kept
    for rows in files:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(in_dir)
        _t.sleep(1.1)  # distinct modification times fix the batch order
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(in_dir)
    q = (stream_daily_series(src, "1 day").writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", ck).trigger(availableNow=True).start(out))
    q.awaitTermination()
    got = {r.ds.day: r.y for r in spark.read.parquet(out).collect()}
    assert got[2] == 1.0 and got[9] == 6.0
    assert sorted(got) == list(range(1, 10))   # final watermark Jan 10 12:00 closes days 1-9 only


day_sets = st.lists(st.integers(min_value=0, max_value=60), min_size=1, max_size=15, unique=True)


@settings(max_examples=15, deadline=None)
@given(st.lists(day_sets, min_size=1, max_size=3))
def test_densify_is_a_gap_free_superset(spark, series_days):
    rows = [(f"s{i}", dt.datetime(2021, 1, 1) + dt.timedelta(days=d), float(d)) for i, ds in enumerate(series_days)
            for d in ds]
    df = spark.createDataFrame(rows, "unique_id string, ds timestamp_ntz, y double")
    out = ti.densify(df).collect()
    for i, ds in enumerate(series_days):
        got = sorted((r.ds, r.y) for r in out if r.unique_id == f"s{i}")
        lo, hi = min(ds), max(ds)
        assert [g[0] for g in got] == [dt.datetime(2021, 1, 1) + dt.timedelta(days=d) for d in range(lo, hi + 1)]
        assert {g[0]: g[1] for g in got if g[1] is not None} == {
            dt.datetime(2021, 1, 1) + dt.timedelta(days=d): float(d) for d in ds}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(min_value=-1e6, max_value=1e6)), min_size=1, max_size=20))
def test_pack_unpack_round_trip_keeps_nulls(spark, ys):
    from tidecast.operators.aggregate import pack_series, unpack_series
    rows = [("a", dt.datetime(2021, 1, 1) + dt.timedelta(days=i), y) for i, y in enumerate(ys)]
    df = spark.createDataFrame(rows, "unique_id string, ds timestamp_ntz, y double")
    back = unpack_series(pack_series(df.repartition(3)), with_pos=True).orderBy("pos").collect()
    assert [r.y for r in back] == ys and [r.pos for r in back] == list(range(len(ys)))

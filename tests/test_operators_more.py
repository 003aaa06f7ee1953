"""Direct unit tests for operator paths the registered queries exercise only indirectly."""

import datetime as dt

from pyspark.sql import functions as F

from tidecast.functions.tokens import EOS_ID, FIRST_ID, PAD_ID, token_centre, token_id
from tidecast.operators import aggregate as agg
from tidecast.operators import sampling as sa
from tidecast.operators import select as sel
from tidecast.operators import splits as sp
from tidecast.operators import timeindex as ti
from tidecast.operators import tokens as tk
from tidecast.schema import SERIES_SCHEMA, conform_schema


def _days(series, k="a", n=10, start=1):
    return series([(k, f"2020-01-{d:02d}", float(d)) for d in range(start, start + n)])


def test_offset_split_negative_offset(series):
    got = sp.offset_split(_days(series), -3).orderBy("ds").collect()
    assert [r.split for r in got] == ["train"] * 7 + ["eval"] * 3


def test_forecast_split_start_after_last(series):
    r = sp.forecast_split(_days(series), "D").first()
    assert r.split == "past" and r.forecast_start == dt.datetime(2020, 1, 11)


def test_weight_repeat_default_weight_one(series):
    df = _days(series, n=2).withColumn("dataset", F.lit("x"))
    assert sa.weight_repeat(df, {"other": 5}).count() == 2
    assert sa.weight_repeat(df, {"x": 3}).count() == 6


def test_patch_series_front_padding(series):
    df = _days(series, n=10)
    cuts = df.sparkSession.createDataFrame([("a", 7)], "unique_id string, cut int")
    w = sp.context_window(df, cuts, 7, 2)
    p = sp.patch_series(w, 4).orderBy("patch", "slot").collect()
    # 7 context slots padded to 8 at the front: one leading pad, then two full patches
    assert len(p) == 8 and p[0].is_pad and p[0].y is None and p[0].patch == 0
    assert [r.y for r in p[1:]] == [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0]
    m = sp.patch_mask(sp.patch_series(w, 4), 0.5, 0.5, 2, 1).orderBy("patch").collect()
    assert [r.is_target for r in m] == [False, True]


def test_token_decode_special_ids_and_round_trip(spark):
    df = spark.createDataFrame([("a", PAD_ID), ("a", EOS_ID), ("a", FIRST_ID), ("a", 2049)], "unique_id string, token int")
    scales = spark.createDataFrame([("a", 2.0)], "unique_id string, scale double")
    got = [r.value for r in tk.token_decode(df, scales).orderBy("token").collect()]
    assert got[0] is None and got[1] is None and got[2] == -30.0 and abs(got[3]) < 1e-9
    v = spark.createDataFrame([(x / 10.0,) for x in range(-150, 151)], "x double")
    back = v.select("x", token_centre(token_id(F.col("x"))).alias("c")).collect()
    assert max(abs(r.x - r.c) for r in back) <= 30.0 / 4092 / 2 + 1e-12


def test_conform_schema_casts_and_nan(spark):
    df = spark.createDataFrame([(7, "2020-01-01 00:00:00", float("nan"), "extra")], "id long, t string, v double, z string")
    r = conform_schema(df, SERIES_SCHEMA, {"id": "unique_id", "t": "ds", "v": "y"}).first()
    assert r == ("7", dt.datetime(2020, 1, 1), None)


def test_date_grid_literal_monthly(spark):
    g = [r.ds for r in ti.date_grid(spark, "2020-01-15", "2020-04-02", "M").collect()]
    assert g == [dt.datetime(2020, 1, 31), dt.datetime(2020, 2, 29), dt.datetime(2020, 3, 31), dt.datetime(2020, 4, 30)]


def test_head_series_only_series(series):
    df = series([(k, "2020-01-01", 1.0) for k in ["c", "a", "b"]])
    assert sorted(r.unique_id for r in sel.head_series(df, k_series=2).collect()) == ["a", "b"]


def test_missing_profile_and_scale(series):
    df = series([("a", "2020-01-01", None), ("a", "2020-01-02", -4.0), ("a", "2020-01-03", 2.0)])
    p = agg.missing_profile(df).first()
    assert (p.n, p.n_missing) == (3, 1) and abs(p.missing_share - 1 / 3) < 1e-12
    w = df.withColumn("window_id", F.lit("w")).withColumn("is_future", F.lit(False))
    assert agg.mean_abs_scale(w).first().scale == 3.0
    z = series([("z", "2020-01-01", 0.0)]).withColumn("window_id", F.lit("w")).withColumn("is_future", F.lit(False))
    assert agg.mean_abs_scale(z).first().scale == 1.0


def test_forecast_udf_context_cut_matches_native_on_the_tail(spark, series):
    from tidecast.operators import forecast as fc
    from tidecast.operators import plugins as pl
    rows = [("a", (dt.date(2020, 1, 1) + dt.timedelta(days=i)).isoformat(), float(i % 5)) for i in range(60)]
    df = series(rows)
    u = pl.forecast_udf(pl.WindowMean(None), h=2, num_samples=1, context=10)
    got = agg.pack_series(df).select(u("y").alias("f")).first().f
    tail = fc.forecast_points(fc.last_points(df, 10), "mean", "D", 2).orderBy("step").collect()
    assert got == [r.yhat for r in tail]

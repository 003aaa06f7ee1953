"""Explicit tests for the survey's quirks not covered elsewhere (Q3, Q11, Q12, Q15, Q17, Q19).
Q1, Q2, Q4-Q10, Q13, Q14, Q16, Q18 are in test_edge_cases.py / test_fixture_edges.py."""

import inspect

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast import constants as C
from tidecast.operators import combine as cb
from tidecast.operators import missing as ms
from tidecast.operators import plugins as pl
from tidecast.operators import sampling as sa
from tidecast.operators import splits as sp
from tidecast.schema import SERIES_SCHEMA, conform_schema


def test_q3_monthly_date_column_becomes_ds(spark):
    import datetime as dt
    df = spark.createDataFrame([("M1", dt.datetime(2018, 1, 31), 1.0)], "unique_id string, date timestamp_ntz, y double")
    assert conform_schema(df, SERIES_SCHEMA, {"date": "ds"}).columns == ["unique_id", "ds", "y"]


def test_q11_horizon_is_required():
    assert inspect.signature(pl.forecast_struct_udf).parameters["h"].default is inspect.Parameter.empty


def test_q12_forecasts_are_double(spark, series):
    packed = spark.createDataFrame([("a", [1.0, 2.0, 3.0])], "unique_id string, y array<double>")
    out = packed.select(pl.forecast_udf(pl.WindowMean(), h=2, num_samples=1)("y").alias("f"))
    assert out.schema["f"].dataType == T.ArrayType(T.DoubleType())


def test_q15_uniform_when_no_probabilities(spark, series):
    a = series([(f"a{i}", "2020-01-01", 1.0) for i in range(3)])
    d = cb.concat_datasets({"a": a, "b": a.withColumn("unique_id", F.concat(F.lit("b"), "unique_id"))})
    got = {r.dataset: r["count"] for r in sa.mixture_sample(d, None, 4000, 2).groupBy("dataset").count().collect()}
    assert abs(got["a"] / 4000 - 0.5) < 0.03


def test_q17_offsets_have_no_default():
    assert inspect.signature(sp.offset_split).parameters["offset"].default is inspect.Parameter.empty


def test_q19_drop_probability_defaults_to_0_2():
    assert inspect.signature(ms.random_drop).parameters["drop_prob"].default == C.DROP_PROB == 0.2

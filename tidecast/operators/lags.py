"""A shared model of several lags, kept as a registry row (rows 63, 64).

All series share ``y_t/s = a + sum_i b_i * y_{t-lag_i}/s`` (s: the series'
mean absolute value).  One pass sums the products of the scaled lags; these
(p + 1)(p + 2) / 2 partial sums are all that moves.  The ridge solve works on
that one row, and the coefficients are the registry row's parameters.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast import constants as C
from tidecast.functions.calendar import add_steps
from tidecast.functions.ranges import positive
from tidecast.operators.forecast import last_points
from tidecast.schema import DS, ID, Y
from tidecast.session import ship_package

LAG_PARAMS = T.StructType([
    T.StructField("lags", T.ArrayType(T.IntegerType())), T.StructField("coef", T.ArrayType(T.DoubleType())),
    T.StructField("intercept", T.DoubleType()), T.StructField("ridge", T.DoubleType()),
    T.StructField("n", T.LongType()), T.StructField("context", T.IntegerType())])


def _check_lags(lags: Sequence[int]) -> list[int]:
    out = [positive("lag", int(k)) for k in lags]
    if not out or len(set(out)) != len(out):
        raise ValueError("lags must be different positive numbers")
    return out


def lag_moments(df: DataFrame, lags: Sequence[int] = (1, 7), context: int | None = C.CONTEXT_LENGTH) -> DataFrame:
    """One row: n and the sums of products of (1, lags..., target) over all points whose lags are all observed.

    Columns ``m_i_j`` for i <= j; index 0 is the constant, the last one the target.
    """
    lags = _check_lags(lags)
    src = last_points(df, context) if context else df
    s = F.avg(F.abs(F.col(Y))).over(Window.partitionBy(ID))
    s = F.when(s > 0, s).otherwise(F.lit(1.0))
    w = Window.partitionBy(ID).orderBy(DS)
    v = src.select((F.col(Y) / s).alias("_t"), *[(F.lag(Y, k).over(w) / s).alias(f"_x{k}") for k in lags])
    cols = [F.lit(1.0), *[F.col(f"_x{k}") for k in lags], F.col("_t")]
    whole = F.col("_t").isNotNull()
    for k in lags:
        whole = whole & F.col(f"_x{k}").isNotNull()
    sums = [F.sum(cols[i] * cols[j]).alias(f"m_{i}_{j}") for i in range(len(cols)) for j in range(i, len(cols))]
    return v.where(whole).agg(F.count(F.lit(1)).alias("n"), *sums)


def solve_ridge(moments: np.ndarray, ridge: float) -> np.ndarray:
    """(intercept, coefficients...) from the matrix of products of (1, lags..., target).

    The penalty ``ridge * n`` weighs on the coefficients, not on the intercept;
    without points, or where nothing can be told, the least solution.
    """
    p = len(moments) - 2
    a = moments[:p + 1, :p + 1].copy()
    a[np.arange(1, p + 1), np.arange(1, p + 1)] += ridge * moments[0, 0]
    return np.linalg.lstsq(a, moments[:p + 1, p + 1], rcond=None)[0]


def pooled_lags_fit(df: DataFrame, lags: Sequence[int] = (1, 7), ridge: float = 0.0,
                    context: int | None = C.CONTEXT_LENGTH, name: str = "pooled_lags",
                    registry: DataFrame | None = None) -> DataFrame:
    """Fit the shared model; a registry row (name, version, params) with lags, coef, intercept and n as columns.

    Version = latest existing version of ``name`` + 1 (1 for a new name).
    Points with a missing value or lag take no part; without any the
    coefficients are 0.
    """
    ship_package(df.sparkSession)
    lags, penalty, ctx = _check_lags(lags), float(ridge), None if context is None else int(context)
    k = len(lags) + 2

    def solve(batches):
        for b in batches:
            for r in b.to_dict("records"):
                m = np.zeros((k, k))
                for i in range(k):
                    for j in range(i, k):
                        value = r[f"m_{i}_{j}"]
                        m[i, j] = m[j, i] = 0.0 if value is None or np.isnan(value) else value
                b0 = solve_ridge(m, penalty)
                params = {"lags": lags, "coef": b0[1:].tolist(), "intercept": float(b0[0]), "ridge": penalty,
                          "n": int(r["n"]), "context": ctx}
                yield pd.DataFrame({"params": [json.dumps(params)]})

    fit = lag_moments(df, lags, context).mapInPandas(solve, "params string")
    if registry is None:
        version = F.lit(1)
    else:
        prev = registry.where(F.col("name") == name).select(F.max(F.col("version").try_cast("int")))
        version = F.coalesce(prev.scalar(), F.lit(0)) + 1
    p = F.from_json("params", LAG_PARAMS)
    return fit.select(F.lit(name).alias("name"), version.cast("string").alias("version"), "params",
                      p["lags"].alias("lags"), p["coef"].alias("coef"), p["intercept"].alias("intercept"), p["n"].alias("n"))


def registry_score_lags(df: DataFrame, registry: DataFrame, name: str, h: int, freq: str = "D",
                        context: int = C.CONTEXT_LENGTH) -> DataFrame:
    """``h`` iterated steps for every series by the newest version of ``name``: unique_id, step, ds, yhat, version.

    A series carries its last observed values as an array as long as the
    greatest lag; where it has fewer, its oldest one stands in.  A series
    without an observed value gets null forecasts.
    """
    h = positive("h", h)
    mine = registry.where(F.col("name") == name)
    newest = mine.select(F.max(F.col("version").try_cast("int"))).scalar()
    chosen = mine.where(F.col("version").try_cast("int") == newest).select(F.max("params")).scalar()
    cut = last_points(df, context)
    st = cut.groupBy(ID).agg(
        F.max(DS).alias("last_ds"), F.avg(F.abs(F.col(Y))).alias("_s"),
        F.array_sort(F.collect_list(F.when(F.col(Y).isNotNull(), F.struct(DS, Y)))).alias("_v"))
    st = st.withColumn("_p", F.from_json(chosen, LAG_PARAMS)).withColumn("version", newest.cast("string"))
    s = F.when(F.col("_s") > 0, F.col("_s")).otherwise(F.lit(1.0))
    st = st.withColumn("_s", s).withColumn("_z", F.transform("_v", lambda e: e[Y] / F.col("_s")))

    def step(acc, _):
        terms = F.zip_with("_p.lags", "_p.coef", lambda lag, b: b * F.element_at(acc, F.greatest(-lag, -F.size(acc))))
        return F.concat(acc, F.array(F.aggregate(terms, F.col("_p.intercept"), lambda t, x: t + x)))

    path = F.aggregate(F.sequence(F.lit(1), F.lit(h)), F.col("_z"), step)
    out = st.select(ID, "last_ds", "version", "_s", F.size("_z").alias("_n"),
                    F.when(F.size("_z") > 0, F.slice(path, F.size("_z") + 1, h)).alias("_f"))
    out = out.select("*", F.explode(F.sequence(F.lit(1), F.lit(h))).alias("step"))
    return out.select(ID, F.col("step").cast("int").alias("step"), add_steps(F.col("last_ds"), F.col("step"), freq).alias(DS),
                      (F.get("_f", F.col("step") - 1) * F.col("_s")).alias("yhat"), "version")

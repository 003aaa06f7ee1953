"""Joins and set operations (rows 51-53)."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.schema import DS, ID, Y


def concat_datasets(datasets: Mapping[str, DataFrame], dataset_col: str = "dataset") -> DataFrame:
    """Chain datasets by column name, tagging each row with its dataset."""
    out = None
    for name, df in datasets.items():
        t = df.withColumn(dataset_col, F.lit(name))
        out = t if out is None else out.unionByName(t, allowMissingColumns=True)
    if out is None:
        raise ValueError("no datasets")
    return out


def forecast_errors(forecast: DataFrame, actual: DataFrame, by: Sequence[str] = (ID,),
                    on: Sequence[str] = (ID, DS), yhat: str = "yhat") -> DataFrame:
    """Align forecasts with actuals (inner equi-join on ``on``) and compute,
    per ``by`` group (empty = overall): n, MSE, MAE and
    NRMSE = sqrt(MSE) / mean(|y|)."""
    j = forecast.select(*on, *[c for c in by if c not in on], yhat).join(
        actual.select(*on, Y), list(on)).where(F.col(Y).isNotNull() & F.col(yhat).isNotNull())
    err = F.col(Y) - F.col(yhat)
    g = j.groupBy(*by) if by else j.groupBy()
    a = g.agg(F.count(F.lit(1)).alias("n"), F.avg(err * err).alias("mse"),
              F.avg(F.abs(err)).alias("mae"), F.avg(F.abs(F.col(Y))).alias("_scale"))
    return a.withColumn("nrmse", F.when(F.col("_scale") > 0, F.sqrt("mse") / F.col("_scale"))).drop("_scale")


def sample_nll(samples: DataFrame, actual: DataFrame, keys: Sequence[str] = (ID, DS),
               by: Sequence[str] = (ID,), value: str = "value") -> DataFrame:
    """Mean negative log-likelihood of actuals under a normal fitted to the
    samples' mean and (sample) standard deviation at each point.

    ``n`` points have a likelihood; ``n_skipped`` have an observed actual but
    samples of zero or undefined spread.  A group of skipped points alone
    stays, with a null ``nll``."""
    st = samples.groupBy(*keys).agg(F.avg(value).alias("mu"), F.stddev_samp(value).alias("sd"))
    j = st.join(actual.select(*keys, Y), list(keys)).where(F.col(Y).isNotNull())
    nll = (F.lit(0.5) * F.log(F.lit(2 * math.pi) * F.col("sd") * F.col("sd"))
           + (F.col(Y) - F.col("mu")) ** 2 / (F.lit(2.0) * F.col("sd") * F.col("sd")))
    told = F.coalesce(F.col("sd") > 0, F.lit(False))
    return j.groupBy(*by).agg(F.count_if(told).alias("n"), F.count_if(~told).alias("n_skipped"),
                              F.avg(F.when(told, nll)).alias("nll"))

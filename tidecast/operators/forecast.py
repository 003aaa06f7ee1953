"""Built-in forecasters as native Spark expressions (rows 57, 60-65).

Built-ins: last value, seasonal last value, mean (optionally of the last
``window`` points), drift, OLS trend over position, AR(1).  All statistics
are per-series window/aggregate expressions over one exchange on
``unique_id``; nothing leaves the JVM.  Missing (NULL) values are skipped
when fitting; horizon timestamps follow the last timestamp of the series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidecast import constants as C
from tidecast.functions.calendar import add_steps, check_freq
from tidecast.functions.ranges import positive
from tidecast.schema import DS, ID, Y

BUILTINS = ("last", "seasonal", "mean", "drift", "trend", "ar1")


def series_stats(df: DataFrame, season: int = 7, window: int | None = None) -> DataFrame:
    """Per-series statistics the built-in forecasters need, one row per series."""
    obs = F.col(Y).isNotNull()
    # One sort per series: positions and lags ride on the ascending order and
    # the rank from the end is n_obs - pos (an unordered window needs no sort).
    w_asc = Window.partitionBy(ID).orderBy(DS).rowsBetween(Window.unboundedPreceding, 0)
    w_lag = Window.partitionBy(ID).orderBy(DS)
    x = (df.withColumn("_pos", F.when(obs, F.count(Y).over(w_asc) - 1))
           .withColumn("_lag", F.lag(Y).over(w_lag))
           .withColumn("_rd", F.when(obs, F.count(Y).over(Window.partitionBy(ID)) - F.col("_pos"))))
    mean_src = F.col(Y) if window is None else F.when(F.col("_rd") <= window, F.col(Y))
    seas = F.array_sort(F.collect_list(
        F.when(F.col("_rd") <= season, F.struct(F.col("_rd").alias("rd"), F.col(Y).alias("v")))))
    return x.groupBy(ID).agg(
        F.max(DS).alias("last_ds"),
        F.count(Y).alias("n_obs"),
        F.max_by(Y, F.when(obs, F.col(DS))).alias("last_y"),
        F.min_by(Y, F.when(obs, F.col(DS))).alias("first_y"),
        F.avg(mean_src).alias("mean_y"),
        F.regr_slope(Y, "_pos").alias("trend_b"),
        F.regr_intercept(Y, "_pos").alias("trend_a"),
        F.regr_slope(Y, "_lag").alias("ar_b"),
        F.regr_intercept(Y, "_lag").alias("ar_a"),
        seas.alias("_season"),
    )


def point_forecast(model: str, step, season: int = 7):
    """yhat for ``step`` given the columns of ``series_stats``."""
    last, n = F.col("last_y"), F.col("n_obs")
    if model == "last":
        return last
    if model == "mean":
        return F.col("mean_y")
    if model == "seasonal":
        k = F.greatest(F.least(F.lit(season), n), F.lit(1))
        idx = k - F.pmod(step - 1, k)
        return F.when(n > 0, F.element_at(F.col("_season"), idx.cast("int"))["v"])
    if model == "drift":
        slope = F.when(n > 1, (last - F.col("first_y")) / (n - 1)).otherwise(F.lit(0.0))
        return last + slope * step
    if model == "trend":
        return F.when(F.col("trend_b").isNull(), last).otherwise(
            F.col("trend_a") + F.col("trend_b") * (n - 1 + step))
    if model == "ar1":
        a, b = F.col("ar_a"), F.col("ar_b")
        bk = F.pow(b, step)
        geo = F.when(b == 1.0, a * step).otherwise(a * (1 - bk) / (1 - b))
        return F.when(b.isNull(), last).otherwise(geo + bk * last)
    raise ValueError(f"unknown built-in model {model!r}; have {BUILTINS}")


def forecast_points(df: DataFrame, model: str = "seasonal", freq: str = "D", h: int = 10,
                    season: int = 7, window: int | None = None, packed: bool = False) -> DataFrame:
    """Horizon timestamps plus forecast per series.

    Long output ``(unique_id, step, ds, yhat)``; ``packed=True`` gives the
    reference's ``(unique_id, ds array, forecast array)``.
    """
    check_freq(freq)
    h, season = positive("h", h), positive("season", season)
    stats = series_stats(df, season=season, window=window)
    steps = stats.select("*", F.explode(F.sequence(F.lit(1), F.lit(int(h)))).alias("step"))
    out = steps.select(ID, F.col("step").cast("int").alias("step"),
                       add_steps(F.col("last_ds"), F.col("step"), freq).alias(DS),
                       point_forecast(model, F.col("step"), season).cast("double").alias("yhat"))
    if not packed:
        return out
    agg = out.groupBy(ID).agg(F.array_sort(F.collect_list(F.struct("step", DS, "yhat"))).alias("_a"))
    return agg.select(ID, F.col(f"_a.{DS}").alias(DS), F.col("_a.yhat").alias("forecast"))


def forecast_samples(df: DataFrame, h: int = C.HORIZON, num_samples: int = C.NUM_SAMPLES, seed: int = 0,
                     freq: str = "D") -> DataFrame:
    """Seeded sample paths by residual bootstrap of one-step changes.

    Residuals r_1..r_m are the changes between consecutive observed points of
    a series.  Path s, step k adds r[floor(u(seed, id, s, k) * m) + 1] to the
    running value starting at the last observation (no residuals: flat).
    Draws are an equi-join on (unique_id, index); the running sum is a window
    per (series, sample).  Output: unique_id, sample, step, ds, value.
    """
    h, num_samples = positive("h", h), positive("num_samples", num_samples)
    obs = df.where(F.col(Y).isNotNull())
    w = Window.partitionBy(ID).orderBy(DS)
    res = obs.withColumn("_r", F.col(Y) - F.lag(Y).over(w)).where(F.col("_r").isNotNull())
    res = res.withColumn("_idx", F.row_number().over(w).cast("long")).select(ID, "_idx", "_r")
    stats = df.groupBy(ID).agg(F.max(DS).alias("last_ds"),
                               F.max_by(Y, F.when(F.col(Y).isNotNull(), F.col(DS))).alias("last_y"),
                               (F.count(Y) - 1).alias("_m"))
    paths = (stats.select("*", F.explode(F.sequence(F.lit(0), F.lit(int(num_samples) - 1))).alias("sample"))
                  .select("*", F.explode(F.sequence(F.lit(1), F.lit(int(h)))).alias("step")))
    from tidecast.functions.rng import uniform
    paths = paths.withColumn("_idx", F.when(
        F.col("_m") > 0, F.floor(uniform(seed, F.col(ID), F.col("sample"), F.col("step")) * F.col("_m")) + 1
    ).cast("long"))
    j = paths.join(res, [ID, "_idx"], "left")
    run = Window.partitionBy(ID, "sample").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    val = F.col("last_y") + F.sum(F.coalesce(F.col("_r"), F.lit(0.0))).over(run)
    return j.select(ID, F.col("sample").cast("int").alias("sample"), F.col("step").cast("int").alias("step"),
                    add_steps(F.col("last_ds"), F.col("step"), freq).alias(DS), val.alias("value"))


def last_points(df: DataFrame, context: int) -> DataFrame:
    """The last ``context`` points of each series (a window group limit, so
    rows beyond it are dropped before the exchange)."""
    w = Window.partitionBy(ID).orderBy(F.col(DS).desc())
    return df.withColumn("_rd", F.row_number().over(w)).where(F.col("_rd") <= int(context)).drop("_rd")


def fit_and_forecast(df: DataFrame, h: int, min_length: int = C.MIN_FIT_LENGTH, fit="trend",
                     steps: int = 10, freq: str = "D", context: int | None = None) -> DataFrame:
    """Per-series fit on series with at least ``min_length`` points, then
    ``h`` steps.  ``fit``: 'trend' (OLS on position), 'ar1' (OLS of y on its
    lag, iterated), or a plug-in Forecaster — one with a ``steps`` attribute
    (iterations of its per-series fit) gets ``steps``.  Every model is fitted
    on the whole series unless ``context`` is given."""
    from tidecast.operators.select import min_length_filter
    src = min_length_filter(df, int(min_length))
    if isinstance(fit, str):
        return forecast_points(src if context is None else last_points(src, context), fit, freq, h)
    from tidecast.operators.plugins import forecast_long
    if hasattr(fit, "steps"):
        import copy
        fit = copy.copy(fit)
        fit.steps = int(steps)
    return forecast_long(src, fit, freq, h, context=context)


def device_partition(df: DataFrame, n: int) -> DataFrame:
    """Spread series over ``n`` devices/slots by hash of ``unique_id``.

    A machine without devices reports 0, which Spark rejects as a number of
    partitions (quirk Q10): there is no slot to keep to then, and the cluster
    sets the number by the table's size, one for a small table.  Hashing on
    the id (rather than round-robin) keeps each series on one slot and lets a
    following per-series aggregate reuse the exchange.
    """
    return df.repartition(int(n), ID) if int(n) >= 1 else df.repartition(ID)

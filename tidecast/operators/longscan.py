"""Scans along a series that no single task could hold (rows 18, 19, 23, 32-36, 43, 57).

The per-series operators use one window per series, so a series is one task's
work.  Here the table is range-partitioned by (series, time): a long series is
cut into chunks, one or more per partition.  Each chunk is scanned by itself
and summed up in one row (count, first and last value, minimum, sums); the
chunks' rows are prefix-combined per series, and every point adds what came
before its chunk.  Results equal those of the window path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidecast import constants as C
from tidecast.functions.calendar import add_steps, check_freq
from tidecast.functions.materialize import materialize
from tidecast.functions.ranges import positive
from tidecast.operators.forecast import point_forecast
from tidecast.schema import DS, ID, Y


def segmented_scan(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """``df`` (unique_id, ds, y) with running columns, whatever the length of a series.

    pos: 0-based position in the order (ds, y), nulls first; n: length;
    obs: observed points up to here; n_obs: observed points; lag_y: the value
    before (null at the start); filled: the last observed value, at the start
    the first one, 0.0 in a series without any; run_min, run_sum, run_sumsq:
    over the observed values so far (null, 0 and 0 before the first).

    One range exchange cuts the series into chunks and is written once to the
    shared folder (equal points are told apart, so no value makes a chunk
    large).  The chunks' summaries are one row per chunk and meet the points
    in an equi-join on the chunk.  Null ids are a series; an empty table gives
    no rows.
    """
    spark = df.sparkSession
    k = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    row = df.select(F.col(ID), DS, Y).withColumn("_tie", F.monotonically_increasing_id())
    cut = row.repartitionByRange(k, F.col(ID), F.col(DS), F.col(Y), F.col("_tie")) \
        .withColumn("_part", F.spark_partition_id())
    cut = materialize(cut.select(F.coalesce(F.col(ID), F.lit("")).alias("_id"), F.col(ID).isNull().alias("_null"),
                                 DS, Y, "_tie", "_part"))
    chunk = ["_part", "_id", "_null"]
    obs = F.col(Y).isNotNull()
    at = F.struct(DS, Y, "_tie")
    inner = Window.partitionBy(*chunk).orderBy(DS, Y, "_tie")
    so_far = inner.rowsBetween(Window.unboundedPreceding, 0)
    x = cut.select(
        *chunk, DS, Y, (F.row_number().over(inner) - 1).alias("_k"), F.count(Y).over(so_far).alias("_o"),
        F.lag(Y).over(inner).alias("_lag"), F.last(Y, ignorenulls=True).over(so_far).alias("_fill"),
        F.min(Y).over(so_far).alias("_min"), F.coalesce(F.sum(Y).over(so_far), F.lit(0.0)).alias("_sum"),
        F.coalesce(F.sum(F.col(Y) * F.col(Y)).over(so_far), F.lit(0.0)).alias("_sq"))
    per = cut.groupBy(*chunk).agg(
        F.count(F.lit(1)).alias("c"), F.count(Y).alias("co"), F.max_by(F.struct(Y), at)[Y].alias("end_y"),
        F.max_by(Y, F.when(obs, at)).alias("last_obs"), F.min_by(Y, F.when(obs, at)).alias("first_obs"),
        F.min(Y).alias("m"), F.sum(Y).alias("s"), F.sum(F.col(Y) * F.col(Y)).alias("q"))
    series = Window.partitionBy("_id", "_null")
    before = series.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = series.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carry = per.select(
        *chunk, F.coalesce(F.sum("c").over(before), F.lit(0)).alias("b_c"),
        F.coalesce(F.sum("co").over(before), F.lit(0)).alias("b_o"), F.lag("end_y").over(series.orderBy("_part")).alias("b_y"),
        F.last("last_obs", ignorenulls=True).over(before).alias("b_fill"), F.min("m").over(before).alias("b_min"),
        F.coalesce(F.sum("s").over(before), F.lit(0.0)).alias("b_s"),
        F.coalesce(F.sum("q").over(before), F.lit(0.0)).alias("b_q"),
        F.sum("c").over(whole).alias("n"), F.sum("co").over(whole).alias("n_obs"),
        F.first("first_obs", ignorenulls=True).over(whole).alias("w_first"))
    j = x.join(carry, chunk)
    return j.select(
        F.when(~F.col("_null"), F.col("_id")).alias(ID), DS, Y, (F.col("b_c") + F.col("_k")).alias("pos"), "n",
        (F.col("b_o") + F.col("_o")).alias("obs"), "n_obs",
        F.when(F.col("_k") == 0, F.col("b_y")).otherwise(F.col("_lag")).alias("lag_y"),
        F.coalesce("_fill", "b_fill", "w_first", F.lit(0.0)).alias("filled"),
        F.least("_min", "b_min").alias("run_min"), (F.col("b_s") + F.col("_sum")).alias("run_sum"),
        (F.col("b_q") + F.col("_sq")).alias("run_sumsq"))


def impute_long(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """``impute(df, "last")`` by a segmented scan."""
    return segmented_scan(df, partitions).select(ID, DS, F.col("filled").alias(Y))


def rebase_daily_long(df: DataFrame, keep: int = C.DAILY_KEEP, start: str = C.DAILY_START,
                      partitions: int | None = None) -> DataFrame:
    """``rebase_daily`` by a segmented scan: the last ``keep`` points, dated daily from ``start``."""
    x = segmented_scan(df, partitions).where(F.col("pos") >= F.col("n") - int(keep))
    day = (F.col("pos") - F.greatest(F.col("n") - int(keep), F.lit(0))).cast("int")
    return x.select(ID, F.date_add(F.to_date(F.lit(start)), day).cast("timestamp_ntz").alias(DS), Y)


def rebase_monthly_long(df: DataFrame, keep: int = C.MONTHLY_KEEP, start: str = C.MONTHLY_START,
                        partitions: int | None = None) -> DataFrame:
    """``rebase_monthly`` by a segmented scan: the first ``keep`` points, dated to month ends from ``start``'s month."""
    x = segmented_scan(df, partitions).where(F.col("pos") < int(keep))
    month = F.add_months(F.to_date(F.lit(start)), F.col("pos").cast("int"))
    return x.select(ID, F.last_day(month).cast("timestamp_ntz").alias(DS), Y)


def offset_split_long(df: DataFrame, offset: int, partitions: int | None = None) -> DataFrame:
    """``offset_split`` by a segmented scan."""
    x = segmented_scan(df, partitions)
    cut = F.lit(int(offset)) if offset >= 0 else F.col("n") + F.lit(int(offset))
    return x.select(ID, DS, Y, F.when(F.col("pos") < cut, "train").otherwise("eval").alias("split"))


def forecast_points_long(df: DataFrame, model: str = "trend", freq: str = "D", h: int = 10, season: int = 7,
                         window: int | None = None, partitions: int | None = None) -> DataFrame:
    """``forecast_points`` by a segmented scan: every statistic is an aggregate over scanned points, combined map-side.

    Only the last ``season`` observed points of a series are ever gathered.
    """
    check_freq(freq)
    h, season = positive("h", h), positive("season", season)
    seen = F.col(Y).isNotNull()
    x = segmented_scan(df, partitions).withColumn("_pos", F.when(seen, F.col("obs") - 1)) \
        .withColumn("_rd", F.when(seen, F.col("n_obs") - F.col("_pos")))
    mean_src = F.col(Y) if window is None else F.when(F.col("_rd") <= window, F.col(Y))
    tail = F.array_sort(F.collect_list(F.when(F.col("_rd") <= season, F.struct(F.col("_rd").alias("rd"), F.col(Y).alias("v")))))
    stats = x.groupBy(ID).agg(
        F.max(DS).alias("last_ds"), F.count(Y).alias("n_obs"),
        F.max(F.when(F.col("_rd") == 1, F.struct(Y)))[Y].alias("last_y"),
        F.max(F.when(F.col("_pos") == 0, F.struct(Y)))[Y].alias("first_y"),
        F.avg(mean_src).alias("mean_y"), F.regr_slope(Y, "_pos").alias("trend_b"),
        F.regr_intercept(Y, "_pos").alias("trend_a"), F.regr_slope(Y, "lag_y").alias("ar_b"),
        F.regr_intercept(Y, "lag_y").alias("ar_a"), tail.alias("_season"))
    steps = stats.select("*", F.explode(F.sequence(F.lit(1), F.lit(h))).alias("step"))
    return steps.select(ID, F.col("step").cast("int").alias("step"),
                        add_steps(F.col("last_ds"), F.col("step"), freq).alias(DS),
                        point_forecast(model, F.col("step"), season).cast("double").alias("yhat"))

"""Model-metadata tables derived from the data.

The reference reads such metadata from a model registry, a run folder and
training logs.  Here they are Spark results over the series, so the queries
that consume them (latest version, latest/next run, best checkpoint, early
stopping) run on tables whose size grows with the data:

* ``backtest_metrics``: rolling-origin validation of the built-in
  forecasters; run = model, epoch = validation window, metric = val/MSE and
  val/MAE (the validation curve a training run logs per epoch).
* ``written_folders``: the names of folders that hold files, read from disk.
* ``run_listing``: the run folders such a sweep leaves (``run-<epoch>``), plus
  per-model log files that do not match the run pattern.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.operators import forecast as fc
from tidecast.operators import splits as sp
from tidecast.schema import DS, ID, Y

MODELS = ("last", "seasonal", "mean", "drift", "trend", "ar1")


def backtest_metrics(df: DataFrame, dataset: str, h: int, windows: int, context: int,
                     freq: str = "D", models=MODELS, season: int = 7) -> DataFrame:
    """Rolling-origin validation of the built-in models: (run, epoch, metric, value) rows."""
    spark = df.sparkSession
    if int(h) < 1 or int(windows) < 1:
        raise ValueError("h and windows must be >= 1")
    specs = sp.eval_grid(spark, dataset, -(windows * h), windows * h, [h], [context], [1])
    wins = sp.rolling_eval_windows(df, specs, dataset)
    past = wins.where(~F.col("is_future") & ~F.col("is_pad")).select(
        F.col("window_id").alias(ID), DS, Y)
    fut = wins.where(F.col("is_future")).select(
        "window_id", "window_no", (F.col("rel") + 1).alias("step"), F.col(Y).alias("_actual"))
    stats = fc.series_stats(past, season=season)
    steps = stats.select("*", F.explode(F.sequence(F.lit(1), F.lit(int(h)))).alias("step"))
    per_model = F.array(*[F.struct(F.lit(m).alias("model"),
                                   fc.point_forecast(m, F.col("step"), season).cast("double").alias("yhat"))
                          for m in models])
    preds = steps.select(F.col(ID).alias("window_id"), "step", F.explode(per_model).alias("_p"))
    preds = preds.select("window_id", "step", "_p.model", "_p.yhat")
    j = preds.join(fut, ["window_id", "step"]).where(F.col("_actual").isNotNull() & F.col("yhat").isNotNull())
    err = F.col("_actual") - F.col("yhat")
    agg = j.groupBy("model", "window_no").agg(F.avg(err * err).alias("mse"), F.avg(F.abs(err)).alias("mae"))
    return agg.select(F.col("model").alias("run"), F.col("window_no").alias("epoch"),
                      F.explode(F.array(F.struct(F.lit("val/MSE").alias("metric"), F.col("mse").alias("value")),
                                        F.struct(F.lit("val/MAE").alias("metric"), F.col("mae").alias("value"))))
                      .alias("_m")).select("run", "epoch", "_m.metric", "_m.value")


def written_folders(spark: SparkSession, path: str) -> DataFrame:
    """Names of the folders below ``path`` that hold files, one per row; file contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    return files.select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("path")).distinct()


def run_listing(metrics: DataFrame) -> DataFrame:
    """The run folders (``run-<epoch>``) and log files such a sweep leaves, one path per row."""
    runs = metrics.select(F.concat(F.lit("run-"), F.col("epoch").cast("string")).alias("path"))
    logs = metrics.select(F.concat(F.col("run"), F.lit(".log")).alias("path"))
    return runs.unionByName(logs).distinct()

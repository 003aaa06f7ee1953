"""Aggregations (rows 23-31)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast import constants as C
from tidecast.schema import DS, ID, Y


def pack_series(df: DataFrame) -> DataFrame:
    """Long -> one row per series with time-ordered ``ds``/``y`` arrays.

    Collects (ds, y) *pairs* and sorts them, so the arrays stay aligned and a
    NULL ``y`` keeps its slot (quirk Q2).  A series is bounded by its calendar
    span at its grain; cut to a context length first when it is not.
    """
    pairs = F.array_sort(F.collect_list(F.struct(F.col(DS).alias("ds"), F.col(Y).alias("y"))))
    agg = df.groupBy(ID).agg(pairs.alias("_p"))
    return agg.select(ID, F.col("_p.ds").alias(DS), F.col("_p.y").alias(Y))


def unpack_series(packed: DataFrame, with_pos: bool = False) -> DataFrame:
    """Packed -> long rows, in array order."""
    z = packed.select(ID, F.posexplode(F.arrays_zip(DS, Y)).alias("pos", "_z"))
    cols = [ID] + (["pos"] if with_pos else []) + [F.col(f"_z.{DS}").alias(DS), F.col(f"_z.{Y}").alias(Y)]
    return z.select(*cols)


def sample_median(samples: DataFrame, qs=(0.5,), value: str = "value",
                  keys=(ID, "step")) -> DataFrame:
    """Elementwise exact quantiles over sample paths, per (series, step).

    ``percentile`` is exact with linear interpolation (``percentile_approx``
    is not: it gives 2, not 2.5, on 1, 2, 3, 10).  A group holds
    ``num_samples`` values, bounded by the parameter.
    """
    keys = [k for k in keys] + ([DS] if DS in samples.columns and DS not in keys else [])
    aggs = []
    for q in qs:
        name = "median" if q == 0.5 else f"q{int(round(q * 100)):02d}"
        aggs.append(F.percentile(F.col(value), F.lit(float(q))).alias(name))
    return samples.groupBy(*keys).agg(*aggs)


def missing_profile(df: DataFrame) -> DataFrame:
    """Length, missing count and missing share per series (NULL = missing)."""
    miss = F.col(Y).isNull().cast("int")
    return df.groupBy(ID).agg(F.count(F.lit(1)).alias("n"), F.sum(miss).alias("n_missing"),
                              F.avg(miss.cast("double")).alias("missing_share"))


def mean_abs_scale(windows: DataFrame, keys=("window_id",), past_only: bool = True) -> DataFrame:
    """Per-context scale = mean(|y|) over observed past values; 1.0 when that is
    not > 0 (all missing or all zero)."""
    src = windows.where(~F.col("is_future")) if past_only and "is_future" in windows.columns else windows
    m = F.avg(F.abs(F.col(Y)))
    return src.groupBy(*keys).agg(F.when(m > 0, m).otherwise(F.lit(1.0)).alias("scale"))


def latest_version(registry: DataFrame, names) -> DataFrame:
    """Highest integer version per model name; 1 when a name has none (quirk
    Q13, kept for parity) with ``exists`` telling the two apart.

    ``names`` is a list or a one-column DataFrame.  The names are unioned
    with the registry rows and aggregated once (partial aggregation first),
    so no join is needed and a name with very many versions is combined
    map-side.
    """
    spark = registry.sparkSession
    if isinstance(names, DataFrame):
        nm = names.select(F.col(names.columns[0]).cast("string").alias("name"))
    else:
        nm = spark.createDataFrame([(str(n),) for n in dict.fromkeys(names)], "name string")
    asked = nm.select("name", F.lit(None).cast("int").alias("_v"))
    if isinstance(names, DataFrame):
        have = registry.join(nm.distinct(), "name", "left_semi")
    else:
        have = registry.where(F.col("name").isin([str(n) for n in dict.fromkeys(names)]))
    # versions are integer text; a row that is not is ignored rather than failing the job
    rows = asked.unionByName(have.select("name", F.col("version").try_cast("int").alias("_v")))
    mx = rows.groupBy("name").agg(F.max("_v").alias("_v"))
    dv = F.lit(C.DEFAULT_VERSION)
    return mx.select("name", F.greatest(F.coalesce(F.col("_v"), dv), dv).alias("version"),
                     F.col("_v").isNotNull().alias("exists"))


def _run_numbers(listing: DataFrame, base: str, sep: str, ext: str, path_col: str):
    stem = F.regexp_replace(F.col(path_col), r"^.*/", "")
    if ext:
        stem = F.regexp_replace(stem, r"\." + ext + "$", "")
    pat = "^" + base + sep + r"(\d+)$"
    num = F.when(stem.rlike(pat), F.regexp_extract(stem, pat, 1).cast("long"))
    return listing.select(num.alias("_n"))


def latest_run(listing: DataFrame, base: str = "run", sep: str = "-", ext: str = "",
               path_col: str = "path") -> DataFrame:
    """Highest ``<base><sep><n>`` number in a listing (NULL when there is none)."""
    return _run_numbers(listing, base, sep, ext, path_col).agg(F.max("_n").alias("latest_run"))


def next_run(listing: DataFrame, base: str = "run", sep: str = "-", ext: str = "",
             base_dir: str = "", path_col: str = "path") -> DataFrame:
    """Next free run path: highest number + 1, starting at 0."""
    n = F.coalesce(F.max("_n"), F.lit(-1)) + 1
    suffix = f".{ext}" if ext else ""
    prefix = (base_dir.rstrip("/") + "/") if base_dir else ""
    nums = _run_numbers(listing, base, sep, ext, path_col)
    return nums.agg(n.alias("next_run")).select(
        "next_run", F.concat(F.lit(prefix + base + sep), F.col("next_run").cast("string"),
                             F.lit(suffix)).alias("next_path"))


def best_checkpoint(metrics: DataFrame, monitor: str, mode: str = "min", k: int = 1) -> DataFrame:
    """Top-``k`` epochs per run by the monitored metric (ties: earliest epoch)."""
    from pyspark.sql import Window
    if mode not in ("min", "max"):
        raise ValueError("mode must be min or max")
    order = F.col("value").asc() if mode == "min" else F.col("value").desc()
    w = Window.partitionBy("run").orderBy(order, F.col("epoch").asc())
    m = metrics.where((F.col("metric") == monitor) & F.col("value").isNotNull())
    return (m.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
             .select("run", "epoch", "value", "rank"))


def early_stop_epoch(metrics: DataFrame, patience: int = C.EARLY_STOP_PATIENCE,
                     min_delta: float = C.EARLY_STOP_MIN_DELTA,
                     monitor: str | None = None) -> DataFrame:
    """Per run: the first epoch at which ``patience`` epochs in a row brought
    no improvement (mode min), the best epoch and value up to the stop.
    ``monitor`` picks one metric of a long metrics table (run, epoch, metric,
    value); without it the table must hold a single metric.

    Improvement means ``value < best - min_delta`` (mode min), where best is
    the last value that counted as an improvement.  For ``min_delta == 0``
    best is the running minimum, so the answer is a set of native windows;
    otherwise it is a sequential fold, run per run in ``applyInPandas`` (a
    group is one run's epochs).
    """
    from pyspark.sql import Window
    if min_delta < 0:
        raise ValueError("min_delta must be >= 0")
    m = metrics.where(F.col("value").isNotNull())
    if monitor is not None:
        m = m.where(F.col("metric") == monitor)
    if min_delta != 0.0:
        return _early_stop_fold(m, patience, float(min_delta))
    w = Window.partitionBy("run").orderBy("epoch")
    prev = Window.partitionBy("run").orderBy("epoch").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("run").orderBy("epoch").rowsBetween(Window.unboundedPreceding, 0)
    x = (m.withColumn("_k", F.row_number().over(w))
          .withColumn("_best_before", F.min("value").over(prev)))
    x = x.withColumn("_imp", F.col("_best_before").isNull() | (F.col("value") < F.col("_best_before")))
    x = x.withColumn("_last_imp", F.max(F.when(F.col("_imp"), F.col("_k"))).over(upto))
    x = x.withColumn("_stop", (F.col("_k") - F.col("_last_imp")) >= patience)
    whole = Window.partitionBy("run")
    y = (x.withColumn("_stop_k", F.min(F.when(F.col("_stop"), F.col("_k"))).over(whole))
          .withColumn("epochs_seen", F.count(F.lit(1)).over(whole))
          .where(F.col("_stop_k").isNull() | (F.col("_k") <= F.col("_stop_k"))))
    return y.groupBy("run").agg(
        F.max(F.when(F.col("_k") == F.col("_stop_k"), F.col("epoch"))).alias("stop_epoch"),
        F.min_by("epoch", F.struct("value", "epoch")).alias("best_epoch"),
        F.min("value").alias("best_value"),
        F.first("epochs_seen").alias("epochs_seen"))


def _early_stop_fold(m: DataFrame, patience: int, min_delta: float) -> DataFrame:
    import pandas as pd

    from tidecast.session import ship_package

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("epoch", kind="mergesort")
        best, best_epoch, wait, stop = float("inf"), None, 0, None
        seen = len(pdf)
        for epoch, value in zip(pdf["epoch"].to_numpy(), pdf["value"].to_numpy(dtype=float)):
            if value < best - min_delta:
                best, best_epoch, wait = value, int(epoch), 0
            else:
                wait += 1
                if wait >= patience:
                    stop = int(epoch)
                    break
        return pd.DataFrame({"run": [pdf["run"].iloc[0]], "stop_epoch": [stop], "best_epoch": [best_epoch],
                             "best_value": [best], "epochs_seen": [seen]})

    ship_package(m.sparkSession)
    return m.select("run", "epoch", "value").groupBy("run").applyInPandas(
        fold, "run string, stop_epoch int, best_epoch int, best_value double, epochs_seen long")

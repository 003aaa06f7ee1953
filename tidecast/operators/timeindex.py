"""Time index operators (rows 17-22)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidecast import constants as C
from tidecast.functions.calendar import add_steps, check_freq
from tidecast.functions.ranges import positive, upto
from tidecast.schema import DS, ID, Y


def _grid_points(start, end, freq: str):
    """Column: array of grid timestamps from ``start`` to ``end`` (inclusive)."""
    s, e = F.to_date(start), F.to_date(end)
    if check_freq(freq) == "D":
        return F.transform(upto(s, e), lambda d: d.cast("timestamp_ntz"))
    n = F.months_between(F.trunc(e, "month"), F.trunc(s, "month")).cast("int")
    return F.transform(upto(F.lit(0), n),
                       lambda k: F.last_day(F.add_months(s, k)).cast("timestamp_ntz"))


def date_grid(src, start=None, end=None, freq: str = "D",
              start_col: str = "start", end_col: str = "end") -> DataFrame:
    """Calendar from start to end, daily or month-end.

    ``src`` is a SparkSession (``start``/``end`` literals: one calendar) or a
    DataFrame with ``start_col``/``end_col`` columns (one calendar per row,
    other columns kept).
    """
    if isinstance(src, SparkSession):
        base = src.range(1).select(F.lit(start).alias(start_col), F.lit(end).alias(end_col))
        keep = []
    else:
        base = src
        keep = [c for c in src.columns if c not in (start_col, end_col)]
    return base.select(*keep, F.explode(_grid_points(F.col(start_col), F.col(end_col), freq)).alias(DS))


def rebase_daily(df: DataFrame, keep: int = C.DAILY_KEEP, start: str = C.DAILY_START) -> DataFrame:
    """Keep the last ``keep`` points per series, re-dated daily from ``start``.

    ``row_number() <= keep`` is planned as a window group limit, so each task
    drops rows beyond the limit before the exchange.
    """
    w = Window.partitionBy(ID).orderBy(F.col(DS).desc())
    kept = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= keep)
    n = F.count(F.lit(1)).over(Window.partitionBy(ID))
    kept = kept.withColumn("_n", n)
    new_ds = F.date_add(F.to_date(F.lit(start)), (F.col("_n") - F.col("_rn")).cast("int"))
    return kept.select(ID, new_ds.cast("timestamp_ntz").alias(DS), Y)


def rebase_monthly(df: DataFrame, keep: int = C.MONTHLY_KEEP, start: str = C.MONTHLY_START) -> DataFrame:
    """Keep the first ``keep`` points per series, re-dated to month ends from
    ``start``'s month.  Shorter series keep their own length (quirk Q5)."""
    w = Window.partitionBy(ID).orderBy(F.col(DS).asc())
    kept = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= keep)
    new_ds = F.last_day(F.add_months(F.to_date(F.lit(start)), (F.col("_rn") - 1).cast("int")))
    return kept.select(ID, new_ds.cast("timestamp_ntz").alias(DS), Y)


def horizon_timestamps(df: DataFrame, freq: str, h: int, as_: str = "array",
                       packed: bool | None = None) -> DataFrame:
    """Next ``h`` timestamps after each series' last one.

    ``as_``: 'array' (array<timestamp>), 'string' (array<string>, 'yyyy-MM-dd
    HH:mm:ss'), or 'long' (one row per step: unique_id, step, ds).
    Native expressions only: no UDF, nothing collected per partition.
    """
    check_freq(freq)
    h = positive("h", h)
    if packed is None:
        packed = dict(df.dtypes).get(DS, "").startswith("array")
    last = (df.select(ID, F.array_max(DS).alias("_last")) if packed
            else df.groupBy(ID).agg(F.max(DS).alias("_last")))
    if as_ == "long":
        steps = last.select(ID, "_last", F.explode(F.sequence(F.lit(1), F.lit(int(h)))).alias("step"))
        return steps.select(ID, F.col("step").cast("int").alias("step"),
                            add_steps(F.col("_last"), F.col("step"), freq).alias(DS))
    arr = F.transform(F.sequence(F.lit(1), F.lit(int(h))),
                      lambda i: add_steps(F.col("_last"), i, freq))
    if as_ == "string":
        arr = F.transform(arr, lambda t: F.date_format(t, "yyyy-MM-dd HH:mm:ss"))
    elif as_ != "array":
        raise ValueError(f"as_ must be array, string or long, got {as_!r}")
    return last.select(ID, arr.alias(DS))


def series_span(df: DataFrame) -> DataFrame:
    """Start, end and point count per series."""
    return df.groupBy(ID).agg(F.min(DS).alias("start"), F.max(DS).alias("end"),
                              F.count(F.lit(1)).alias("n"))


def densify(df: DataFrame, freq: str = "D") -> DataFrame:
    """Put every series on a gap-free grid from its first to its last point;
    missing ``y`` is NULL.

    Each point emits itself plus the grid points up to (not including) the
    next point of its series (``lead``), so densifying is one window pass
    over one exchange on ``unique_id``: no span aggregate, no self-join, and
    the output stays partitioned by series.  Timestamps must be on the grid
    (day starts for 'D', month ends for 'M', as ``series_from_facts`` makes).
    """
    check_freq(freq)
    w = Window.partitionBy(ID).orderBy(DS)
    nxt = F.lead(DS).over(w)
    x = df.select(ID, DS, Y, nxt.alias("_next"))
    d0 = F.to_date(DS)
    if freq == "D":
        gap = F.when(F.col("_next").isNull(), F.lit(0)).otherwise(
            F.greatest(F.datediff(F.to_date("_next"), d0) - 1, F.lit(0)))
        pts = F.transform(F.sequence(F.lit(0), gap), lambda k: F.date_add(d0, k).cast("timestamp_ntz"))
    else:
        gap = F.when(F.col("_next").isNull(), F.lit(0)).otherwise(F.greatest(
            F.months_between(F.trunc(F.to_date("_next"), "month"), F.trunc(d0, "month")).cast("int") - 1, F.lit(0)))
        pts = F.transform(F.sequence(F.lit(0), gap),
                          lambda k: F.last_day(F.add_months(d0, k)).cast("timestamp_ntz"))
    e = x.select(ID, DS, Y, F.posexplode(pts).alias("_k", "_ds"))
    return e.select(ID, F.col("_ds").alias(DS), F.when(F.col("_k") == 0, F.col(Y)).alias(Y))

"""Projections, filters and limits (rows 10-16)."""

from __future__ import annotations


from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidecast.schema import DS, ID, Y

def id_range(prefix: str, lo: int, hi_exclusive: int) -> list[str]:
    """``[prefix+lo, ..., prefix+(hi-1)]``; the reference's daily set is
    ``range(1, n)`` (n-1 ids) and its monthly one ``range(1, n+1)`` (quirk Q1)."""
    return [f"{prefix}{i}" for i in range(lo, hi_exclusive)]


def sample_series_ids(df: DataFrame, ids) -> DataFrame:
    """Keep series whose id is in ``ids`` (a list or a one-column DataFrame).

    A list is a literal set on the id column, which reaches the scan
    (``PushedFilters: In``); values that the column's type can't hold match
    nothing.  A DataFrame of ids is a semi-join; AQE picks broadcast or
    sort-merge by its measured size.
    """
    if isinstance(ids, DataFrame):
        keys = ids.select(F.col(ids.columns[0]).cast("string").alias(ID)).distinct()
        return df.join(keys, ID, "left_semi")
    return df.where(F.col(ID).isin([str(i) for i in dict.fromkeys(ids)]))


def fact_ids(facts: DataFrame, id_col: str, ids) -> DataFrame:
    """Keep the facts whose id, as text, is in the list ``ids``.

    The ids take the column's own type, so that the filter reaches the scan;
    an id that the type can't hold matches nothing.
    """
    kind = dict(facts.dtypes)[id_col]
    wanted = [str(i) for i in dict.fromkeys(ids)]
    if kind in ("tinyint", "smallint", "int", "bigint"):
        top = 1 << {"tinyint": 7, "smallint": 15, "int": 31, "bigint": 63}[kind]
        plain = [i for i in wanted if i.lstrip("-").isascii() and i.lstrip("-").isdigit() and str(int(i)) == i]
        return facts.where(F.col(id_col).isin([int(i) for i in plain if -top <= int(i) < top]))
    return facts.where((F.col(id_col) if kind == "string" else F.col(id_col).cast("string")).isin(wanted))


def select_series(packed: DataFrame, unique_id: str) -> DataFrame:
    """One series of a packed table as (timestamp, value) rows, in time order."""
    one = packed.where(F.col(ID) == F.lit(unique_id))
    z = one.select(F.posexplode(F.arrays_zip(DS, Y)).alias("_pos", "_z"))
    return z.select(F.col("_z")[DS].alias("timestamp"), F.col("_z")[Y].alias("value"))


def min_length_filter(df: DataFrame, k: int, packed: bool | None = None) -> DataFrame:
    """Keep series with at least ``k`` points.

    Packed input: ``size(ds) >= k``.  Long input: a per-series window count,
    so the filter happens *before* any packing and shares the exchange on
    ``unique_id`` with whatever follows.  Packed input is recognised by its
    array-typed ``ds`` unless ``packed`` says otherwise.
    """
    if packed is None:
        packed = dict(df.dtypes).get(DS, "").startswith("array")
    if packed:
        return df.where(F.size(DS) >= k)
    n = F.count(F.lit(1)).over(Window.partitionBy(ID))
    return df.withColumn("_n", n).where(F.col("_n") >= k).drop("_n")


def observed_filter(df: DataFrame, min_length: int = 0, max_missing_prop: float = 1.0) -> DataFrame:
    """Keep series with ``length >= min_length`` and missing share
    ``<= max_missing_prop`` (missing = NULL ``y``; densify first for gaps)."""
    w = Window.partitionBy(ID)
    return (df.withColumn("_n", F.count(F.lit(1)).over(w))
              .withColumn("_miss", F.avg(F.col(Y).isNull().cast("double")).over(w))
              .where((F.col("_n") >= min_length) & (F.col("_miss") <= max_missing_prop))
              .drop("_n", "_miss"))


def flatten_forecast(df: DataFrame, col: str = "forecast") -> DataFrame:
    """``struct<timestamp: array<string>, forecast: array<double>>`` -> one row per step."""
    inner = df.select(ID, F.col(f"{col}.timestamp").alias("_ts"),
                      F.col(f"{col}.forecast").alias("_fc"))
    z = inner.select(ID, F.posexplode(F.arrays_zip(F.col("_ts").alias("timestamp"),
                                                    F.col("_fc").alias("forecast"))).alias("_p", "_z"))
    return z.select(ID, (F.col("_p") + 1).cast("int").alias("step"),
                    F.col("_z.timestamp").alias("timestamp"),
                    F.col("_z.forecast").alias("forecast"))


def head_series(df: DataFrame, k_series: int | None = None, k_points: int | None = None) -> DataFrame:
    """First ``k_series`` series by id and/or first ``k_points`` points of each.

    The ids are a top-k over the distinct ids; the planner chooses the semi-join.
    """
    out = df
    if k_series is not None:
        ids = df.select(ID).distinct().orderBy(ID).limit(int(k_series))
        out = out.join(ids, ID, "left_semi")
    if k_points is not None:
        w = Window.partitionBy(ID).orderBy(DS)
        out = out.withColumn("_rn", F.row_number().over(w)).where(
            F.col("_rn") <= int(k_points)).drop("_rn")
    return out

"""Fact rows -> canonical long series at day or month-end grain (row 2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.functions.calendar import floor_to
from tidecast.schema import DS, ID, Y, nan_to_null

_AGGS = {"sum": F.sum, "avg": F.avg, "mean": F.avg, "min": F.min, "max": F.max,
         "count": F.count, "last": None}


def series_from_facts(df: DataFrame, id_col: str, ts_col: str, value: str,
                      agg: str = "sum", grain: str = "D", decimals: int | None = None) -> DataFrame:
    """``groupBy(id, floor(ts)).agg(value)`` -> (unique_id, ds, y).

    One shuffle on (unique_id, ds) with map-side partial aggregation, so a hot
    id (even a third of all facts) is combined per task before the exchange
    and each (id, day) group is a single row afterwards.  NaN facts count
    as missing (a day with only missing facts gets NULL).

    With ``decimals`` the facts have that many decimals (money, quantities):
    sums are then taken over exact decimals and don't depend on their order.
    """
    if agg not in _AGGS or agg == "last":
        raise ValueError(f"unsupported agg {agg!r}")
    keyed = df.select(F.col(id_col).cast("string").alias(ID),
                      floor_to(F.col(ts_col), grain).alias(DS),
                      nan_to_null(F.col(value).cast("double")).alias("_v"))
    if decimals is not None and agg == "sum":
        keyed = keyed.withColumn("_v", F.col("_v").cast(f"decimal(18,{int(decimals)})"))
    return keyed.groupBy(ID, DS).agg(_AGGS[agg]("_v").cast("double").alias(Y))

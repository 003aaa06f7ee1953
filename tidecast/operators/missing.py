"""Missing values and augmentation (rows 43, 44)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidecast import constants as C
from tidecast.functions.rng import uniform
from tidecast.schema import DS, ID, Y


def impute(df: DataFrame, method: str = "last") -> DataFrame:
    """Fill missing ``y``.

    ``last``: carry the last observed value forward; a leading gap takes the
    first observed value; a series with no observed value becomes 0.
    ``leave``: keep gaps as they are.
    """
    if method == "leave":
        return df
    if method != "last":
        raise ValueError("method must be 'last' or 'leave'")
    run = Window.partitionBy(ID).orderBy(DS).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(ID)
    ff = F.last(Y, ignorenulls=True).over(run)
    first_obs = F.min_by(Y, F.when(F.col(Y).isNotNull(), F.col(DS))).over(whole)
    return df.withColumn(Y, F.coalesce(F.col(Y), ff, first_obs, F.lit(0.0)))


def random_drop(df: DataFrame, drop_prob: float = C.DROP_PROB, seed: int = 0) -> DataFrame:
    """Per series draw p uniform in [0, drop_prob]; set each point to NULL
    with probability p.  Draws are keyed by (series) and (series, timestamp),
    so no window or ordering is needed and retries repeat the same drops."""
    p = uniform(seed, F.col(ID), "p") * F.lit(float(drop_prob))
    # whole seconds, and the microseconds where there are any: points within a second draw apart
    micros = F.date_format(F.col(DS), "SSSSSS")
    at = F.concat(F.date_format(F.col(DS), "yyyyMMddHHmmss"), F.when(micros == "000000", "").otherwise(F.concat(F.lit("."), micros)))
    u = uniform(seed, F.col(ID), at)
    return df.withColumn(Y, F.when(u < p, F.lit(None).cast("double")).otherwise(F.col(Y)))

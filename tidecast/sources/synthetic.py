"""Random daily series (row 3): N(0, 1) per (item, day), keyed randomness."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast import constants as C
from tidecast.functions.ranges import upto
from tidecast.functions.rng import normal


def synth_series(ids, start: str = C.SYNTH_START, end: str = C.SYNTH_END,
                 seed: int = 0, id_col: str = "unique_id", n: int | None = None) -> DataFrame:
    """One N(0,1) value per id and day in [start, end].

    ``ids`` is a DataFrame of item ids (so the work grows with the id table),
    or a SparkSession with ``n``: ids ``item_0`` ... ``item_{n-1}``.
    Each value depends only on (seed, id, day), so the job is retry-safe.
    """
    if isinstance(ids, SparkSession):
        if n is None:
            raise ValueError("n is required with a SparkSession")
        ids = ids.range(int(n)).select(F.concat(F.lit("item_"), F.col("id").cast("string")).alias(id_col))
    days = F.transform(upto(F.to_date(F.lit(start)), F.to_date(F.lit(end))), lambda d: F.struct(
        d.cast("timestamp_ntz").alias("ds"), F.date_format(d, "yyyyMMdd").alias("key")))
    # a table of ids is small and comes in few partitions, its days are many: the ids are spread over tasks first
    spark = ids.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    out = (ids.select(F.col(id_col).cast("string").alias("unique_id")).repartition(n)
              .select("unique_id", F.explode(days).alias("_d")))
    return out.select("unique_id", F.col("_d.ds").alias("ds"), normal(seed, F.col("unique_id"), F.col("_d.key")).alias("y"))

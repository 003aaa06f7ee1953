"""File sinks and scans: long CSV (row 7) and training records (rows 8, 9)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast import constants as C

CSV_SCHEMA = T.StructType([
    T.StructField("ts", T.TimestampNTZType(), True),
    T.StructField("item_id", T.StringType(), True),
    T.StructField("target", T.DoubleType(), True),
])

RECORD_SCHEMA = T.StructType([
    T.StructField("unique_id", T.StringType(), True),
    T.StructField("start", T.TimestampNTZType(), True),
    T.StructField("target", T.ArrayType(T.FloatType()), True),
])

_TS_FMT = "yyyy-MM-dd HH:mm:ss"


def csv_long_sink(df: DataFrame, path: str, id_col: str = "unique_id",
                  ds_col: str = "ds", y_col: str = "y") -> str:
    """Write a long table as CSV (ts, item_id, target) with a header."""
    (df.select(F.col(ds_col).alias("ts"), F.col(id_col).cast("string").alias("item_id"),
               F.col(y_col).cast("double").alias("target"))
       .write.mode("overwrite").option("header", True)
       .option("timestampNTZFormat", _TS_FMT).csv(path))
    return path


def csv_long_scan(spark: SparkSession, path: str) -> DataFrame:
    """Read long CSV with an explicit schema (no inference) onto (unique_id, ds, y)."""
    df = (spark.read.schema(CSV_SCHEMA).option("header", True)
          .option("timestampNTZFormat", _TS_FMT).csv(path))
    return df.select(F.col("item_id").alias("unique_id"), F.col("ts").alias("ds"),
                     F.col("target").alias("y"))


def train_record_sink(packed: DataFrame, path: str,
                      default_start: str = C.RECORD_DEFAULT_START,
                      compression: str = "lz4") -> str:
    """Packed series -> (unique_id, start, target float[]) records.

    ``start`` is the first timestamp, or ``default_start`` when a series has
    none.  Parquet with lz4 stands in for the reference's Arrow file.
    """
    out = packed.select(
        "unique_id",
        F.coalesce(F.array_min("ds"),
                   F.lit(default_start).cast("timestamp_ntz")).alias("start"),
        F.col("y").cast(T.ArrayType(T.FloatType())).alias("target"))
    out.write.mode("overwrite").option("compression", compression).parquet(path)
    return path


def train_record_scan(spark: SparkSession, paths: str | Sequence[str], freq: str) -> DataFrame:
    """Read training records and attach the fixed frequency code."""
    if isinstance(paths, str):
        paths = [paths]
    return spark.read.schema(RECORD_SCHEMA).parquet(*paths).withColumn("freq", F.lit(freq))

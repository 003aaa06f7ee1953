"""Canonical schemas and schema conformance (inventory row 14)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ID, DS, Y = "unique_id", "ds", "y"

SERIES_SCHEMA = T.StructType([
    T.StructField(ID, T.StringType(), True),
    T.StructField(DS, T.TimestampNTZType(), True),
    T.StructField(Y, T.DoubleType(), True),
])

PACKED_SCHEMA = T.StructType([
    T.StructField(ID, T.StringType(), True),
    T.StructField(DS, T.ArrayType(T.TimestampNTZType()), True),
    T.StructField(Y, T.ArrayType(T.DoubleType()), True),
])

FORECAST_LONG_SCHEMA = T.StructType([
    T.StructField(ID, T.StringType(), True),
    T.StructField("step", T.IntegerType(), True),
    T.StructField(DS, T.TimestampNTZType(), True),
    T.StructField("yhat", T.DoubleType(), True),
])


def nan_to_null(c: Column) -> Column:
    """NaN is the reference's missing value; ours is NULL."""
    return F.nanvl(c, F.lit(None).cast("double"))


def as_ts(c: Column) -> Column:
    """Any date/timestamp column as TIMESTAMP_NTZ (no time-zone shift for NTZ input)."""
    return c.cast(T.TimestampNTZType())


def canonical(df: DataFrame, id_col: str = ID, ds_col: str = DS, y_col: str = Y) -> DataFrame:
    """Project any (id, time, value) columns onto the canonical long schema."""
    return df.select(
        F.col(id_col).cast("string").alias(ID),
        as_ts(F.col(ds_col)).alias(DS),
        nan_to_null(F.col(y_col).cast("double")).alias(Y),
    )


def conform_schema(df: DataFrame, schema: T.StructType,
                   renames: Mapping[str, str] | None = None) -> DataFrame:
    """Rename, then cast every field of ``schema``; raise if one is missing.

    Columns not named in ``schema`` are dropped, so the result has exactly
    the declared signature (the reference declares signatures at UDF and
    model boundaries; we declare them everywhere and infer nothing).
    """
    renames = dict(renames or {})
    cols = {renames.get(c, c): c for c in df.columns}
    missing = [f.name for f in schema.fields if f.name not in cols]
    if missing:
        raise ValueError(f"missing required columns {missing}; have {sorted(cols)}")
    out = []
    for f in schema.fields:
        c = F.col(f"`{cols[f.name]}`").cast(f.dataType)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = nan_to_null(c).cast(f.dataType)
        out.append(c.alias(f.name))
    return df.select(*out)

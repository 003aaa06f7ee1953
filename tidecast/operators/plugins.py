"""Plug-in forecasters behind Arrow-batched pandas UDFs (rows 58, 59, 61).

A plug-in is any picklable object with

    setup() -> None                       # load weights etc., once per task
    predict(contexts: list[np.ndarray], h: int, num_samples: int) -> np.ndarray
        # shape (len(contexts), num_samples, h); NaN marks missing input

The model is set up once per task (per Python worker iterator), batches of
``batch_size`` contexts are predicted at a time, and exactly one output batch
is yielded per input batch (a UDF that yields once per partition loses rows
as soon as a partition has more than one Arrow batch).
The plug-ins shipped here are plain statistical ones, named as such; they
exist so the operator can be run and checked without a neural network.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast import constants as C
from tidecast.functions.calendar import check_freq
from tidecast.schema import DS, ID, Y
from tidecast.session import ship_package

#: Bytes of whole series that go to Python in one Arrow batch.
BATCH_BYTES = 4 << 20


class Forecaster:
    """Plug-in contract: ``setup()`` once per task, ``predict(contexts, h, num_samples)``."""

    def setup(self) -> None:  # pragma: no cover - trivial
        pass

    def predict(self, contexts, h: int, num_samples: int) -> np.ndarray:
        raise NotImplementedError


class SeasonalNaive(Forecaster):
    """Repeat the last ``season`` observed values (fewer if the series is shorter)."""

    def __init__(self, season: int = 7):
        self.season = int(season)

    def predict(self, contexts, h, num_samples):
        out = np.full((len(contexts), num_samples, h), np.nan)
        for i, c in enumerate(contexts):
            v = c[~np.isnan(c)]
            if len(v) == 0:
                continue
            k = min(self.season, len(v))
            tail = v[-k:]
            out[i, :, :] = tail[np.arange(h) % k]
        return out


class WindowMean(Forecaster):
    """Mean of the last ``window`` observed values (all when None)."""

    def __init__(self, window: int | None = None):
        self.window = window

    def predict(self, contexts, h, num_samples):
        out = np.full((len(contexts), num_samples, h), np.nan)
        for i, c in enumerate(contexts):
            v = c[~np.isnan(c)]
            if self.window is not None:
                v = v[-self.window:]
            if len(v):
                out[i] = v.mean()
        return out


class Drift(Forecaster):
    """Last value plus the average change from first to last observation."""

    def predict(self, contexts, h, num_samples):
        out = np.full((len(contexts), num_samples, h), np.nan)
        steps = np.arange(1, h + 1, dtype=float)
        for i, c in enumerate(contexts):
            v = c[~np.isnan(c)]
            if len(v) == 0:
                continue
            slope = (v[-1] - v[0]) / (len(v) - 1) if len(v) > 1 else 0.0
            out[i] = v[-1] + slope * steps
        return out


def _as_context(arr) -> np.ndarray:
    return np.array([], dtype=float) if arr is None else np.asarray(arr, dtype=float)


def _cut(c, context: int | None):
    """The last ``context`` values of an array column, cut on the JVM side (all when None)."""
    c = F.col(c) if isinstance(c, str) else c
    return c if context is None else F.slice(c, F.greatest(F.size(c) - F.lit(int(context) - 1), F.lit(1)), int(context))


def _medians(model: Forecaster, contexts: list, h: int, num_samples: int, batch_size: int) -> list:
    out: list = []
    for i in range(0, len(contexts), batch_size):
        samples = np.asarray(model.predict(contexts[i:i + batch_size], h, num_samples), dtype=float)
        out.extend(np.median(samples, axis=1))
    return out


def forecast_udf(model: Forecaster, h: int = C.HORIZON, num_samples: int = C.NUM_SAMPLES,
                 batch_size: int = C.BATCH_SIZE, context: int | None = C.CONTEXT_LENGTH):
    """Packed ``y`` arrays -> median forecast arrays, ``batch_size`` contexts a call.

    Each array is cut to its last ``context`` values on the JVM side first,
    which bounds an Arrow batch at records x context doubles however long the
    series are; ``context=None`` hands over whole arrays.
    """
    ship_package()

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def _udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model.setup()
        for batch in batches:
            yield pd.Series(_medians(model, [_as_context(s) for s in batch], h, num_samples, batch_size),
                            index=batch.index, dtype=object)

    return lambda col: _udf(_cut(col, context))


class DriftClient:
    """A stand-in for a hosted forecasting client.

    ``forecast(frame, h, finetune_steps)`` takes one long frame (unique_id,
    timestamp, value) with many series and returns the next ``h`` daily
    timestamps ('YYYY-mm-dd HH:MM:SS') and values of each, in the order of
    the series in the frame.  Drift has nothing to fine-tune, so the steps
    change nothing here.
    """

    def forecast(self, frame: pd.DataFrame, h: int, finetune_steps: int = 0) -> pd.DataFrame:
        groups = [g for _, g in frame.groupby("unique_id", sort=False)]
        values = Drift().predict([g["value"].to_numpy(dtype=float) for g in groups], h, 1)[:, 0]
        last = pd.DatetimeIndex([g["timestamp"].max() for g in groups])
        days = last.repeat(h) + pd.to_timedelta(np.tile(np.arange(1, h + 1), len(groups)), unit="D")
        return pd.DataFrame({"unique_id": np.repeat([g["unique_id"].iloc[0] for g in groups], h),
                             "timestamp": days.strftime("%Y-%m-%d %H:%M:%S"), "value": values.ravel()})


STRUCT_TYPE = T.StructType([
    T.StructField("timestamp", T.ArrayType(T.StringType())),
    T.StructField("forecast", T.ArrayType(T.DoubleType())),
])


def forecast_struct_udf(client_factory: Callable[[], object], h: int, context: int | None = C.CONTEXT_LENGTH,
                        finetune_steps: int = 0, batch_size: int = 256):
    """Two array columns (ds, y) -> struct<timestamp, forecast>, by a client built once per task.

    The client gets ``batch_size`` series in one long frame a call, with
    ``finetune_steps``.  Both arrays are cut to their last ``context`` entries
    on the JVM side first; ``None`` hands over whole series.  An Arrow batch
    holds at most BATCH_BYTES, however many series those are.
    """
    ship_package()
    spark = SparkSession.getActiveSession()
    if spark is not None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))

    @F.pandas_udf(STRUCT_TYPE)
    def _udf(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        client = client_factory()
        for stamps, values in batches:
            done = []
            for lo in range(0, len(stamps), batch_size):
                t, v = stamps.iloc[lo:lo + batch_size], values.iloc[lo:lo + batch_size]
                size = [len(x) for x in t]
                frame = pd.DataFrame({"unique_id": np.repeat(np.arange(len(t)), size),
                                      "timestamp": pd.to_datetime(np.concatenate([np.asarray(x) for x in t])),
                                      "value": np.concatenate([_as_context(x) for x in v])})
                answer = client.forecast(frame, h, finetune_steps)
                done += [(g["timestamp"].tolist(), g["value"].tolist()) for _, g in answer.groupby("unique_id", sort=True)]
            yield pd.DataFrame(done, columns=["timestamp", "forecast"], index=stamps.index)

    return lambda ds, y: _udf(_cut(ds, context), _cut(y, context))


def forecast_long(df: DataFrame, model, freq: str = "D", h: int = C.HORIZON, context: int | None = C.CONTEXT_LENGTH,
                  value_col: str = Y, num_samples: int = 1, batch_size: int = C.BATCH_SIZE) -> DataFrame:
    """Long in, long out over all series: each series is cut to its last
    ``context`` points (all when None), then forecast by a built-in (native)
    or a plug-in.  For a plug-in the cut series are packed natively and go
    through ``mapInPandas``: one ``setup()`` per task, ``batch_size`` contexts
    per ``predict``.  ``value_col`` names the value column when it is not
    ``y``.  Output: unique_id, step, ds, yhat."""
    from tidecast.functions.calendar import add_steps
    from tidecast.operators.aggregate import pack_series
    from tidecast.operators.forecast import forecast_points, last_points

    check_freq(freq)
    if value_col != Y:
        df = df.withColumn(Y, F.col(value_col).cast("double"))
    src = df.select(ID, DS, Y)
    cut = src if context is None else last_points(src, context)
    if isinstance(model, str):
        return forecast_points(cut, model, freq, h)
    ship_package(df.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model.setup()
        for b in batches:
            yield pd.DataFrame({ID: b[ID], "last_ds": b["last_ds"], "yhat": pd.Series(
                _medians(model, [_as_context(y) for y in b[Y]], h, num_samples, batch_size), index=b.index, dtype=object)})

    packed = pack_series(cut).select(ID, F.array_max(DS).alias("last_ds"), Y)
    out = packed.mapInPandas(run, f"{ID} string, last_ds timestamp_ntz, yhat array<double>")
    return out.select(ID, "last_ds", F.posexplode("yhat").alias("_k", "yhat")).select(
        ID, (F.col("_k") + 1).cast("int").alias("step"),
        add_steps(F.col("last_ds"), F.col("_k") + 1, freq).alias(DS), "yhat")

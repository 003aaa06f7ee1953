"""Streaming series construction and stateful contexts (rows 69, 70)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from tidecast import constants as C
from tidecast.schema import DS, ID, Y
from tidecast.session import ship_package


def stream_daily_series(stream: DataFrame, delay: str = "1 day", id_col: str = "event_type",
                        ts_col: str = "ts", value_col: str = "value") -> DataFrame:
    """Event stream -> daily (unique_id, ds, y) in append mode.

    A day is emitted once the watermark (max event time seen - ``delay``)
    passes its end.  A row is dropped as late when it is older than the
    watermark the previous micro-batch closed days with (Spark's rule for
    late events); rows for days still open are added.  The state holds one
    partial sum per (open day, id).
    """
    x = stream.select(F.col(id_col).cast("string").alias(ID), wall_clock_instant(F.col(ts_col)).alias("_t"),
                      F.col(value_col).alias("_v"))
    agg = (x.withWatermark("_t", delay).groupBy(F.window("_t", "1 day"), ID)
             .agg(F.sum("_v").cast("double").alias(Y)))
    return agg.select(ID, _day(F.col("window.start")).alias(DS), Y)


def open_days(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The days that a stopped ``stream_daily_series`` query still holds in its state: (unique_id, ds, y so far).

    The rows come from the state store below ``checkpoint``.  After a bounded
    run they complete what the query has emitted: a day is in one of the two.
    """
    state = spark.read.format("statestore").load(checkpoint)
    total = state.schema["value"].dataType.fieldNames()[0]          # the only buffer: the day's sum
    return state.select(F.col(f"key.{ID}").alias(ID), _day(F.col("key.window.start")).alias(DS),
                        F.col(f"value.`{total}`").cast("double").alias(Y))


def _day(start):
    """Day of a window's start, in UTC, as TIMESTAMP_NTZ."""
    days = F.floor(F.unix_micros(start) / F.lit(86_400_000_000)).cast("int")
    return F.date_from_unix_date(days).cast("timestamp_ntz")


def wall_clock_instant(c):
    """TIMESTAMP_NTZ -> TIMESTAMP holding the same wall clock as UTC.

    Event time must be a TIMESTAMP for watermarks; a plain cast would read
    the wall clock in the session time zone, shifting day windows.  Epoch
    arithmetic keeps days aligned with the NTZ calendar in any session zone.
    """
    c = F.col(c) if isinstance(c, str) else c
    days = F.unix_date(F.to_date(c)).cast("long")
    tod = (F.hour(c) * 3600 + F.minute(c) * 60).cast("long") * 1_000_000 + \
        (F.second(c).cast("long") * 1_000_000) + \
        F.pmod((F.date_format(c, "SSSSSS")).cast("long"), F.lit(1_000_000))
    return F.timestamp_micros(days * 86_400_000_000 + tod)


def _context_updater(length: int):
    def update(key, pdfs, state):
        times, values, updates = [], [], 0
        if state.exists:
            ds0, y0, updates = state.get
            times.append(np.array(list(ds0), "datetime64[us]"))
            values.append(np.array([np.nan if v is None else v for v in y0], dtype=float))
        for p in pdfs:
            times.append(p[DS].to_numpy("datetime64[us]"))
            values.append(p[Y].to_numpy(float))
        t, y = np.concatenate(times), np.concatenate(values)
        # merge on ds: a newer row for the same timestamp replaces the older one
        _, last = np.unique(t[::-1], return_index=True)
        kept = (len(t) - 1 - last)[-length:]
        ds_list = t[kept].tolist()
        y_list = [None if v != v else v for v in y[kept].tolist()]
        state.update((ds_list, y_list, updates + 1))
        yield pd.DataFrame({ID: [key[0]], "updates": [updates + 1], "n": [len(ds_list)],
                            "last_ds": [ds_list[-1] if ds_list else None],
                            "context": [y_list]})
    return update


def stream_context(stream: DataFrame, length: int = C.CONTEXT_LENGTH) -> DataFrame:
    """Keep the last ``length`` points of every series as state and emit the
    current context of each series updated in a micro-batch.

    Rows are merged into the state by timestamp, so out-of-order and late
    rows land in their place (and a repeated timestamp replaces the old
    value); state per series is bounded by ``length``.  ``updates`` counts
    the micro-batches that touched the series, so the newest context of a
    series is its row with the highest ``updates``.
    """
    ship_package(stream.sparkSession)
    return stream.select(ID, DS, Y).groupBy(ID).applyInPandasWithState(
        _context_updater(int(length)),
        f"{ID} string, updates long, n long, last_ds timestamp_ntz, context array<double>",
        "ds array<timestamp_ntz>, y array<double>, updates long", "append", GroupStateTimeout.NoTimeout)

"""Scoring requests on batch or streaming DataFrames (rows 66-68).

The reference serves forecasts behind a REST endpoint and captures every
request/response pair to a payload table.  Here requests are rows (a JSON
string column) arriving through Structured Streaming; scoring is stateless
and native (``from_json`` + higher-order array functions + ``to_json``), so a
micro-batch scales like any projection.  No server, no port.

Accepted request shapes (fixed formats of the serving contract):
  {"inputs": [[v, ...], ...]}     a batch of contexts, horizon 10
  {"inputs": [v, ...]}            one context, horizon 10
  {"dataframe_split": {"columns": ["timestamp", "value"], "index": [...],
                       "data": [["YYYY-mm-dd HH:MM:SS", v], ...]},
   "params": {"h": 20, "freq": "M", "finetune_steps": 5}}
                                  one series with timestamps in any order; h
                                  defaults to 12, freq to "D", steps to 0
Replies: {"predictions": [[...], ...]} / {"predictions": [...]} /
{"predictions": [{"timestamp": ..., "forecast": ...}, ...]}.  A row that
matches no shape gets NULL reply and an ``error``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast import constants as C
from tidecast.functions.calendar import add_steps
from tidecast.functions.ranges import upto
from tidecast.session import ship_package
from tidecast.sources.tables import check_free, drop_if_exists

INPUTS_H = C.HORIZON
SPLIT_H_DEFAULT = C.SPLIT_REQUEST_HORIZON

_BATCH = T.StructType([T.StructField("inputs", T.ArrayType(T.ArrayType(T.DoubleType())))])
_SINGLE = T.StructType([T.StructField("inputs", T.ArrayType(T.DoubleType()))])
_SPLIT = T.StructType([
    T.StructField("dataframe_split", T.StructType([
        T.StructField("columns", T.ArrayType(T.StringType())),
        T.StructField("index", T.ArrayType(T.LongType())),
        T.StructField("data", T.ArrayType(T.ArrayType(T.StringType())))])),
    T.StructField("params", T.StructType([T.StructField("h", T.IntegerType()), T.StructField("freq", T.StringType()),
                                          T.StructField("finetune_steps", T.IntegerType())])),
])

REQUEST_FILE_SCHEMA = T.StructType([T.StructField("request_id", T.StringType()),
                                    T.StructField("request", T.StringType())])


def array_forecast(ctx: Column, h, model: str = "seasonal", season: int = 7) -> Column:
    """Built-in forecasts over an array context, as higher-order functions."""
    v = F.filter(ctx, lambda x: x.isNotNull() & ~F.isnan(x))
    n = F.size(v)
    steps = upto(F.lit(1), h if isinstance(h, Column) else F.lit(int(h)))
    last = F.element_at(v, -1)
    if model == "last":
        out = F.transform(steps, lambda i: last)
    elif model == "mean":
        mean = F.aggregate(v, F.lit(0.0), lambda a, x: a + x) / n
        out = F.transform(steps, lambda i: mean)
    elif model == "drift":
        slope = F.when(n > 1, (last - F.element_at(v, 1)) / (n - 1)).otherwise(F.lit(0.0))
        out = F.transform(steps, lambda i: last + slope * i)
    elif model == "seasonal":
        k = F.least(F.lit(season), n)
        out = F.transform(steps, lambda i: F.element_at(v, n - k + 1 + F.pmod(i - 1, k)))
    else:
        raise ValueError(f"unknown model {model!r}")
    return F.when(n > 0, out)


def _plugin_forecast(model):
    """A plug-in (see ``operators.plugins``) over all contexts of a request: set up once per task.

    A plug-in with a ``steps`` attribute gets the request's fine-tuning steps.
    """
    ship_package()

    @F.pandas_udf(T.ArrayType(T.ArrayType(T.DoubleType())))
    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        model.setup()
        for contexts, horizons, steps in batches:
            out = [None] * len(contexts)
            # requests of one horizon and number of steps are predicted together
            for (h, k), rows in pd.DataFrame({"h": horizons.to_numpy(), "k": steps.to_numpy()}).groupby(["h", "k"]).groups.items():
                rows = [i for i in rows if contexts.iloc[i] is not None and h > 0]
                flat = [np.asarray(c, dtype=float) if c is not None else np.zeros(0) for i in rows for c in contexts.iloc[i]]
                if not flat:
                    continue
                if hasattr(model, "steps"):
                    model.steps = int(k)
                got = np.median(np.asarray(model.predict(flat, int(h), 1), dtype=float), axis=1)
                at = 0
                for i in rows:
                    n = len(contexts.iloc[i])
                    out[i] = [None if np.isnan(g).any() else g.tolist() for g in got[at:at + n]]
                    at += n
            yield pd.Series(out, index=contexts.index, dtype=object)

    return run


def score_requests(df: DataFrame, model: str = "seasonal", season: int = 7,
                   request_col: str = "request") -> DataFrame:
    """Add ``kind``, ``h``, ``reply`` (JSON) and ``error`` to request rows; ``model`` is a built-in's name, a plug-in,
    or a function of an array column and a horizon that gives an array column.  Beside them
    ``predictions`` (array<array<double>>, one entry per context) and
    ``pred_ds`` (the horizon timestamps of a dataframe_split request)."""
    r = F.col(request_col)
    b = F.from_json(r, _BATCH)["inputs"]
    s = F.from_json(r, _SINGLE)["inputs"]
    sp = F.from_json(r, _SPLIT)
    x = df.withColumn("_b", b).withColumn("_s", s).withColumn("_sp", sp)
    kind = (F.when(F.col("_sp.dataframe_split.data").isNotNull(), F.lit("dataframe_split"))
             .when(F.col("_b").isNotNull() & (F.size("_b") > 0) & F.forall("_b", lambda a: a.isNotNull()),
                   F.lit("inputs_batch"))
             .when(F.col("_s").isNotNull() & (F.size("_s") > 0), F.lit("inputs")))
    x = x.withColumn("kind", kind)
    h = (F.when(F.col("kind") == "dataframe_split",
                F.coalesce(F.col("_sp.params.h"), F.lit(SPLIT_H_DEFAULT)))
          .when(F.col("kind").isNotNull(), F.lit(INPUTS_H)))
    x = x.withColumn("h", h.cast("int"))
    cols = F.col("_sp.dataframe_split.columns")
    # columns of their own, so that each is computed once a request, not once a row or step of it
    x = x.withColumn("_ti", F.array_position(cols, "timestamp").cast("int"))
    x = x.withColumn("_vi", F.array_position(cols, "value").cast("int"))
    ts_i, val_i, data = F.col("_ti"), F.col("_vi"), F.col("_sp.dataframe_split.data")
    has_cols = (ts_i > 0) & (val_i > 0)
    # try_cast: one malformed cell marks the request bad instead of failing the job
    x = x.withColumn("_rv", F.transform(data, lambda row: F.when(has_cols, F.element_at(row, val_i))))
    x = x.withColumn("_rt", F.transform(data, lambda row: F.when(has_cols, F.element_at(row, ts_i))))
    x = x.withColumn("_v", F.transform("_rv", lambda v: v.try_cast("double")))
    x = x.withColumn("_t", F.transform("_rt", lambda t: t.try_cast("timestamp_ntz")))
    x = x.withColumn("_last", F.array_max("_t"))
    raw_vals, split_vals, split_ts = F.col("_rv"), F.col("_v"), F.col("_t")
    freq = F.coalesce(F.col("_sp.params.freq"), F.lit("D"))
    # rows of a request may come in any order: (timestamp, value) pairs are sorted
    ordered = F.transform(F.array_sort(F.arrays_zip(split_ts.alias("t"), split_vals.alias("v"))), lambda e: e["v"])
    split_bad = (~has_cols | ~freq.isin("D", "M") | F.exists(F.arrays_zip(raw_vals.alias("r"), split_vals.alias("c")),
                                      lambda e: e["r"].isNotNull() & e["c"].isNull())
                 | F.exists(split_ts, lambda t: t.isNull()))
    contexts = (F.when(F.col("kind") == "inputs_batch", F.col("_b"))
                 .when(F.col("kind") == "inputs", F.array(F.col("_s")))
                 .when(F.col("kind") == "dataframe_split", F.array(ordered)))
    if isinstance(model, str):
        x = x.withColumn("predictions", F.transform(contexts, lambda c: array_forecast(c, F.col("h"), model, season)))
    elif not hasattr(model, "predict"):
        x = x.withColumn("predictions", F.transform(contexts, lambda c: model(c, F.col("h"))))
    else:
        steps = F.coalesce(F.col("_sp.params.finetune_steps"), F.lit(0))
        x = x.withColumn("predictions", _plugin_forecast(model)(contexts, F.coalesce(F.col("h"), F.lit(0)), steps))
    last_ts = F.col("_last")
    x = x.withColumn("pred_ds", F.when(F.col("kind") == "dataframe_split", F.transform(
        upto(F.lit(1), F.col("h")), lambda i: F.when(freq == "M", add_steps(last_ts, i, "M")).otherwise(
            add_steps(last_ts, i, "D")))))
    split_reply = F.arrays_zip(F.transform("pred_ds", lambda t: F.date_format(t, "yyyy-MM-dd HH:mm:ss")).alias("timestamp"),
                               F.element_at("predictions", 1).alias("forecast"))
    reply = (F.when(F.col("kind") == "inputs_batch", F.to_json(F.struct(F.col("predictions").alias("predictions"))))
              .when(F.col("kind") == "inputs", F.to_json(F.struct(F.element_at("predictions", 1).alias("predictions"))))
              .when(F.col("kind") == "dataframe_split", F.to_json(F.struct(split_reply.alias("predictions")))))
    bad_h = F.col("h") < 1
    bad_split = (F.col("kind") == "dataframe_split") & split_bad
    bad = F.col("kind").isNull() | bad_h | bad_split | F.exists("predictions", lambda p: p.isNull())
    # NULL predictions for bad rows, so consumers explode them without a
    # filter on ``error`` (a filter above this projection would be rewritten
    # in terms of the parse and evaluated again)
    error = (F.when(F.col("kind").isNull(), F.lit("malformed request"))
              .when(bad_h, F.lit("horizon must be >= 1"))
              .when(bad_split, F.lit("malformed dataframe_split"))
              .when(bad, F.lit("empty context")))
    x = x.select("*", F.when(~bad, reply).alias("reply"), error.alias("error"))
    x = x.withColumn("predictions", F.when(F.col("error").isNull(), F.col("predictions")))
    return x.drop("_b", "_s", "_sp", "_ti", "_vi", "_rv", "_rt", "_v", "_t", "_last")


def reply_rows(scored: DataFrame, id_col: str = "request_id") -> DataFrame:
    """Scored requests -> one row per (request, context row, step); rows with
    an error have NULL predictions and yield nothing."""
    # outer generators + a filter on their output: a plain posexplode makes
    # Catalyst infer size(predictions) > 0 and push it below the projections,
    # re-evaluating the whole parse inside the filter
    z = scored.select(id_col, "kind", F.posexplode_outer("predictions").alias("row", "_p")).where(
        F.col("_p").isNotNull())
    z = z.select(id_col, "kind", F.col("row").cast("int").alias("row"),
                 F.posexplode_outer("_p").alias("step", "yhat")).where(F.col("step").isNotNull())
    return z.withColumn("step", (F.col("step") + 1).cast("int"))


def payload_capture(scored: DataFrame, table: str, checkpoint: str,
                    request_col: str = "request", id_col: str = "request_id", once: bool = True):
    """Append request, reply, error and capture time to ``table`` from a
    streaming DataFrame; the checkpoint makes the sink exactly-once."""
    out = scored.select(id_col, request_col, "kind", "reply", "error",
                        F.current_timestamp().alias("captured_at"))
    w = (out.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint))
    check_free(scored.sparkSession, table)
    if once:
        w = w.trigger(availableNow=True)
    return w.toTable(table)


def online_forecast_stream(spark: SparkSession, in_dir: str, prefix: str, checkpoint: str,
                           model: str = "seasonal", season: int = 7, drop_first: bool = True):
    """Request files (JSON lines: request_id, request) -> score -> payload
    table ``<prefix>_payload``.  Returns the started StreamingQuery."""
    table = f"{prefix}_payload"
    if drop_first:
        drop_if_exists(spark, table)
    src = spark.readStream.schema(REQUEST_FILE_SCHEMA).json(in_dir)
    return payload_capture(score_requests(src, model, season), table, checkpoint)


_R_BATCH = T.StructType([T.StructField("predictions", T.ArrayType(T.ArrayType(T.DoubleType())))])
_R_SINGLE = T.StructType([T.StructField("predictions", T.ArrayType(T.DoubleType()))])
_R_SPLIT = T.StructType([T.StructField("predictions", T.ArrayType(T.StructType([
    T.StructField("timestamp", T.StringType()), T.StructField("forecast", T.DoubleType())])))])


def parse_replies(payload: DataFrame, id_col: str = "request_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """Captured replies -> (request_id, kind, row, step, yhat) and the columns ``keep``, the same long
    form as ``reply_rows`` (for reading a payload table back).  The payload's
    ``kind`` tells a reply's shape; request ids may be any text."""
    r = F.col("reply")
    split = F.from_json(r, _R_SPLIT)["predictions"]
    batch = F.from_json(r, _R_BATCH)["predictions"]
    single = F.from_json(r, _R_SINGLE)["predictions"]
    x = payload.where(r.isNotNull())
    preds = (F.when(F.col("kind") == "dataframe_split", F.array(F.transform(split, lambda e: e["forecast"])))
              .when(F.col("kind") == "inputs_batch", batch)
              .otherwise(F.array(single)))
    z = x.select(id_col, "kind", *keep, F.posexplode(preds).alias("row", "_p"))
    return z.select(id_col, "kind", *keep, F.col("row").cast("int").alias("row"),
                    F.posexplode("_p").alias("step", "yhat")).withColumn("step", (F.col("step") + 1).cast("int"))

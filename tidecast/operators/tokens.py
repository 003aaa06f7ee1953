"""Training-token tables (rows 54-56).

``token_table`` is one Spark job: observed filter -> (impute for causal
models) -> random drop -> random cuts -> context windows -> non-empty
contexts -> mean-abs scale -> quantised tokens.  Up to the packing every stage
is a window keyed by series, on one partitioning; from there on a series is an
array, and cuts, windows and tokens are array expressions on it: no window's
points are exploded and nothing is exchanged again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidecast.functions.calendar import add_steps
from tidecast.functions.materialize import materialize
from tidecast.functions.tokens import EOS_ID, IGNORE, PAD_ID, token_centre, token_id
from tidecast.operators.missing import impute, random_drop
from tidecast.operators.select import observed_filter
from tidecast import constants as C
from tidecast.operators.splits import packed_cuts, packed_points, window_arrays
from tidecast.schema import DS, ID, Y


def tokenize_windows(wins: DataFrame, model_type: str = "seq2seq", key: str = "window_id") -> DataFrame:
    """Windows (long) -> one row per window with ``input_ids``,
    ``attention_mask``, ``labels`` and ``scale``.

    seq2seq: input = context tokens + EOS; labels = future tokens + EOS,
    missing labels -100.  causal: ``observed context ++ future ++ EOS ++
    padding`` (left padding moved to the right), labels = the same ids,
    masked positions -100 in labels and PAD in inputs; the context carries no
    EOS of its own.
    """
    if model_type not in ("seq2seq", "causal"):
        raise ValueError("model_type must be seq2seq or causal")
    past_abs = F.when(~F.col("is_future"), F.abs(F.col(Y)))
    m = F.avg(past_abs).over(Window.partitionBy(key))
    x = wins.withColumn("scale", F.when(m > 0, m).otherwise(F.lit(1.0)))
    obs = F.col(Y).isNotNull()
    x = x.withColumn("_tok", F.when(obs, token_id(F.col(Y) / F.col("scale"))).otherwise(F.lit(PAD_ID)))
    items = F.array_sort(F.collect_list(F.struct(F.col("rel").alias("rel"), F.col("_tok").alias("tok"),
                                                 obs.alias("m"), F.col("is_pad").alias("pad"))))
    keep = [F.first("forecast_start").alias("forecast_start")] if "forecast_start" in wins.columns else []
    g = x.groupBy(ID, key).agg(F.first("scale").alias("scale"), *keep, items.alias("_it"))
    meta = [ID, key, "scale"] + (["forecast_start"] if keep else [])
    past = F.filter("_it", lambda e: e["rel"] < 0)
    fut = F.filter("_it", lambda e: e["rel"] >= 0)
    eos_i, eos_m = F.array(F.lit(EOS_ID)), F.array(F.lit(True))
    if model_type == "seq2seq":
        ids = F.concat(F.transform(past, lambda e: e["tok"]), eos_i)
        mask = F.concat(F.transform(past, lambda e: e["m"]), eos_m)
        labels = F.concat(F.transform(fut, lambda e: F.when(e["m"], e["tok"]).otherwise(F.lit(IGNORE))), eos_i)
        return g.select(*meta, ids.alias("input_ids"), mask.alias("attention_mask"), labels.alias("labels"))
    real = F.filter(past, lambda e: ~e["pad"])
    pads = F.filter(past, lambda e: e["pad"])
    raw = F.concat(F.transform(real, lambda e: e["tok"]), F.transform(fut, lambda e: e["tok"]), eos_i,
                   F.transform(pads, lambda e: F.lit(PAD_ID)))
    mask = F.concat(F.transform(real, lambda e: e["m"]), F.transform(fut, lambda e: e["m"]), eos_m,
                    F.transform(pads, lambda e: F.lit(False)))
    g = g.select(*meta, raw.alias("_raw"), mask.alias("attention_mask"))
    return g.select(*meta,
                    F.zip_with("_raw", "attention_mask", lambda t, mm: F.when(mm, t).otherwise(F.lit(PAD_ID))).alias("input_ids"),
                    "attention_mask",
                    F.zip_with("_raw", "attention_mask", lambda t, mm: F.when(mm, t).otherwise(F.lit(IGNORE))).alias("labels"))


def tokenize_arrays(wins: DataFrame, model_type: str = "seq2seq") -> DataFrame:
    """``tokenize_windows`` on windows whose ``past`` and ``future`` are arrays: no explode, no exchange."""
    if model_type not in ("seq2seq", "causal"):
        raise ValueError("model_type must be seq2seq or causal")
    seen = F.filter(F.transform("past", lambda e: F.abs(e[Y])), lambda v: v.isNotNull())
    x = wins.withColumn("_v", seen)
    m = F.aggregate("_v", F.lit(0.0), lambda a, v: a + v) / F.size("_v")
    x = x.withColumn("scale", F.when((F.size("_v") > 0) & (m > 0), m).otherwise(F.lit(1.0)))
    token = lambda e: F.struct(
        F.when(e[Y].isNotNull(), token_id(e[Y] / F.col("scale"))).otherwise(F.lit(PAD_ID)).alias("tok"),
        e[Y].isNotNull().alias("m"), e["is_pad"].alias("pad"))
    g = x.select(ID, "window_id", "scale", "forecast_start", F.transform("past", token).alias("_past"),
                 F.transform("future", token).alias("_fut"))
    meta = [ID, "window_id", "scale", "forecast_start"]
    eos = F.array(F.struct(F.lit(EOS_ID).alias("tok"), F.lit(True).alias("m"), F.lit(False).alias("pad")))
    if model_type == "seq2seq":
        inp, fut = F.concat("_past", eos), F.concat("_fut", eos)
        return g.select(*meta, F.transform(inp, lambda e: e["tok"]).alias("input_ids"),
                        F.transform(inp, lambda e: e["m"]).alias("attention_mask"),
                        F.transform(fut, lambda e: F.when(e["m"], e["tok"]).otherwise(F.lit(IGNORE))).alias("labels"))
    # observed context, future, EOS, then the padding; nothing padded or missing counts
    pads = F.transform(F.filter("_past", lambda e: e["pad"]), lambda e: F.struct(
        F.lit(PAD_ID).alias("tok"), F.lit(False).alias("m"), F.lit(True).alias("pad")))
    g = g.select(*meta, F.concat(F.filter("_past", lambda e: ~e["pad"]), "_fut", eos, pads).alias("_all"))
    return g.select(*meta, F.transform("_all", lambda e: F.when(e["m"], e["tok"]).otherwise(F.lit(PAD_ID))).alias("input_ids"),
                    F.transform("_all", lambda e: e["m"]).alias("attention_mask"),
                    F.transform("_all", lambda e: F.when(e["m"], e["tok"]).otherwise(F.lit(IGNORE))).alias("labels"))


MODES = ("training", "validation", "test")


def token_table(df: DataFrame, context_length: int = C.CONTEXT_LENGTH, prediction_length: int = 64,
                min_past: int = C.MIN_PAST, max_missing_prop: float = C.MAX_MISSING_PROP,
                drop_prob: float = C.DROP_PROB, num_instances: float = 1.0, seed: int = 0,
                model_type: str = "seq2seq", mode: str = "training", freq: str = "D") -> DataFrame:
    """The token-table job (see module docstring).  Input: a long series
    table on a gap-free grid (``densify`` first), missing ``y`` NULL.

    ``mode`` picks the cuts: 'training' random ones (with random drop of
    points), 'validation' the last ``prediction_length`` points of each series
    as the future, 'test' the whole series as the past and an empty future.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    x = observed_filter(df, min_past + prediction_length, max_missing_prop)
    if model_type == "causal":
        x = impute(x, "last")
    h = prediction_length
    if mode == "training":
        if drop_prob > 0:
            x = random_drop(x, drop_prob, seed)
        # written once: the mean number of cuts and the windows both read it
        cuts = packed_cuts(materialize(packed_points(x)), min_past, h, num_instances, seed)
    elif mode == "validation":
        p = packed_points(x).where(F.col("n") > h)
        cuts = p.withColumn("cut", (F.col("n") - h).cast("int")).withColumn("forecast_start", F.get("_p", F.col("cut"))[DS])
    else:
        h = 0
        p = packed_points(x)
        cuts = p.withColumn("cut", F.col("n").cast("int")).withColumn(
            "forecast_start", add_steps(F.element_at("_p", -1)[DS], F.lit(1), freq))
    return tokenize_arrays(window_arrays(cuts, context_length, h, nonempty=True), model_type)


def causal_token_table(df: DataFrame, **kw) -> DataFrame:
    """``token_table`` for decoder-only models (impute first, padding moved right)."""
    return token_table(df, model_type="causal", **kw)


def token_decode(token_samples: DataFrame, scales: DataFrame, token: str = "token",
                 on=(ID,)) -> DataFrame:
    """Token ids -> values: bin centre x scale (NULL for special ids).
    ``scales`` is one row per key; it is joined on ``on``."""
    j = token_samples.join(scales.select(*on, "scale"), list(on))
    return j.withColumn("value", token_centre(F.col(token)) * F.col("scale"))

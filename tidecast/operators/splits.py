"""Splits, context windows and evaluation sets (rows 32-42).

Windows are long tables, one row per (window, relative position):
``unique_id, window_id, cut, rel, ds, y, is_pad, is_future`` where ``rel``
runs from ``-context_length`` to ``h - 1`` and ``cut`` is the 0-based
position of the first future point.  Each series is packed once, and every
window is a slice of its series' array: one exchange on ``unique_id``, and no
join of exploded window rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidecast import constants as C
from tidecast.functions.calendar import add_steps
from tidecast.functions.positions import series_position
from tidecast.functions.ranges import upto
from tidecast.functions.rng import uniform
from tidecast.schema import DS, ID, Y



def _with_len(df: DataFrame) -> DataFrame:
    """Attach 0-based ``pos`` and series length ``n`` (kept if already there)."""
    if "pos" in df.columns and "n" in df.columns:
        return df
    pos = series_position(df, "pos")
    return pos.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(ID)))


def offset_split(df: DataFrame, offset: int) -> DataFrame:
    """First ``offset`` points per series are 'train', the rest 'eval'
    (negative offset counts from the end, as a Python slice does)."""
    x = _with_len(df)
    cut = F.lit(offset) if offset >= 0 else F.col("n") + F.lit(offset)
    return x.select(ID, DS, Y, F.when(F.col("pos") < cut, "train").otherwise("eval").alias("split"))


def holdout_split(df: DataFrame, h: int) -> DataFrame:
    """Validation cut: the last ``h`` points are the future."""
    x = _with_len(df)
    return x.select(ID, DS, Y, F.when(F.col("pos") >= F.col("n") - h, "future")
                    .otherwise("past").alias("split"))


def forecast_split(df: DataFrame, freq: str = "D") -> DataFrame:
    """Test cut: the whole series is past; the forecast starts one step after
    the last timestamp."""
    last = F.max(DS).over(Window.partitionBy(ID))
    return df.select(ID, DS, Y, F.lit("past").alias("split"),
                     add_steps(last, F.lit(1), freq).alias("forecast_start"))


def holdout_cuts(df: DataFrame, h: int) -> DataFrame:
    """Validation cuts for ``context_window``: one per series, ``h`` points before its end.  Series of at most ``h`` points have none."""
    x = _with_len(df)
    return x.where(F.col("pos") == F.col("n") - h).where(F.col("n") > h).select(
        ID, F.col("pos").alias("cut"), F.col(DS).alias("forecast_start"))


def forecast_cuts(df: DataFrame, freq: str = "D") -> DataFrame:
    """Test cuts for ``context_window``: one per series, after its last point, where the forecast starts."""
    return df.groupBy(ID).agg(F.count(F.lit(1)).cast("int").alias("cut"), F.max(DS).alias("_last")).select(
        ID, "cut", add_steps(F.col("_last"), F.lit(1), freq).alias("forecast_start"))


def random_cut_split(df: DataFrame, min_past: int, h: int, num_instances: float = 1.0,
                     seed: int = 0) -> DataFrame:
    """Training cuts.

    Valid cuts of a series of length n are positions t with ``min_past <= t
    <= n - h``.  Each is kept when ``u(seed, id, t) < num_instances / A``,
    where A is the mean number of valid cuts over series that have any, and a
    series whose draws keep nothing keeps its smallest draw (at least one).
    A is a scalar subquery (one aggregate row), not a join.
    """
    x = _with_len(df)
    valid = x.where((F.col("pos") >= min_past) & (F.col("pos") <= F.col("n") - h))
    # the normaliser needs only series lengths: a plain count, no window sort
    per = (df.groupBy(ID).agg(F.max("n").alias("n")) if "n" in df.columns
           else df.groupBy(ID).agg(F.count(F.lit(1)).alias("n")))
    nvalid = F.col("n") - F.lit(h) - F.lit(min_past) + 1
    avg_valid = per.where(nvalid > 0).select(F.avg(nvalid)).scalar()
    p = F.lit(float(num_instances)) / avg_valid
    v = valid.withColumn("_u", uniform(seed, F.col(ID), F.col("pos")))
    v = v.withColumn("_umin", F.min("_u").over(Window.partitionBy(ID)))
    keep = v.where((F.col("_u") < p) | (F.col("_u") == F.col("_umin")))
    return keep.select(ID, F.col("pos").alias("cut"), F.col(DS).alias("forecast_start"))


def packed_points(df: DataFrame) -> DataFrame:
    """One row per series: its points in time order as an array, and their number.

    A series is bounded by its calendar span at its grain, like every
    per-series array here; this is the only exchange the windows need.
    """
    order = ["pos"] if "pos" in df.columns else [DS, Y]
    item = F.struct(*order, *[c for c in (DS, Y) if c not in order])
    p = df.groupBy(ID).agg(F.array_sort(F.collect_list(item)).alias("_p"))
    return p.select(ID, F.transform("_p", lambda e: F.struct(e[DS].alias(DS), e[Y].alias(Y))).alias("_p"),
                    F.size("_p").alias("n"))


def _expand(cuts: DataFrame, context_length, h, key_cols, nonempty: bool = False) -> DataFrame:
    """Rows of each cut's window, read from the series array ``_p`` that the cut's row carries.

    ``cuts`` has unique_id, cut, _p and the key columns.  The past and future
    are slices of the array; positions before its start or after its end have
    no point.  With ``nonempty`` windows without an observed past value go.
    """
    ctx = context_length if hasattr(context_length, "alias") else F.lit(int(context_length))
    hh = h if hasattr(h, "alias") else F.lit(int(h))
    c = cuts.withColumn("_ctx", ctx).withColumn("_from", F.greatest(F.col("cut") - ctx, F.lit(0)))
    c = c.withColumn("_w", F.slice("_p", F.col("_from") + 1, F.greatest(F.col("cut") + hh - F.col("_from"), F.lit(0))))
    if nonempty:
        c = c.where(F.exists(F.slice("_w", F.lit(1), F.col("cut") - F.col("_from")), lambda e: e[Y].isNotNull()))
    # outer: a generator that drops empty arrays would push a second copy of the slice below itself
    rel = c.select(*key_cols, "cut", "_from", "_w", F.explode_outer(upto(-F.col("_ctx"), hh - 1)).alias("rel"))
    rel = rel.where(F.col("rel").isNotNull())
    e = F.get("_w", F.col("cut") + F.col("rel") - F.col("_from"))
    point = F.when(F.col("cut") + F.col("rel") >= 0, e)
    return rel.select(*key_cols, "cut", "rel", point[DS].alias(DS), point[Y].alias(Y),
                      (F.col("cut") + F.col("rel") < 0).alias("is_pad"), (F.col("rel") >= 0).alias("is_future"))


def context_window(df: DataFrame, cuts: DataFrame, context_length: int, h: int, nonempty: bool = False) -> DataFrame:
    """Per cut: ``context_length`` past points (left padded with NULL and
    ``is_pad``), ``h`` future points, and ``forecast_start`` when the cuts
    carry it (``random_cut_split`` does).

    Each series is packed once and meets its cuts in one join on the series
    id; a window is a slice of its series, never a join of exploded points.
    With ``nonempty`` windows without an observed past value are left out, as
    ``nonempty_context`` does.
    """
    extra = ["forecast_start"] if "forecast_start" in cuts.columns else []
    c = cuts.select(ID, "cut", *extra).withColumn("window_id", F.concat_ws("#", ID, F.col("cut").cast("string")))
    return _expand(c.join(packed_points(df), ID), context_length, h, [ID, "window_id", *extra], nonempty)


def packed_cuts(packed: DataFrame, min_past: int, h: int, num_instances: float = 1.0, seed: int = 0) -> DataFrame:
    """``random_cut_split`` on packed series (``_p``, ``n``): one row per cut, with the series' array and forecast_start.

    The draws are an array per series, so no exchange and no window is needed;
    the mean number of valid cuts is a scalar subquery over ``packed``, which
    should be written, or cheap to read twice.
    """
    nvalid = F.col("n") - F.lit(int(h)) - F.lit(int(min_past)) + 1
    avg_valid = packed.where(nvalid > 0).select(F.avg(nvalid)).scalar()
    x = packed.where(nvalid > 0).withColumn("_keep", F.lit(float(num_instances)) / avg_valid)
    x = x.withColumn("_us", F.transform(
        F.sequence(F.lit(int(min_past)), F.col("n") - F.lit(int(h))),
        lambda t: F.struct(t.cast("int").alias("cut"), uniform(seed, F.col(ID), t).alias("u"))))
    x = x.withColumn("_umin", F.array_min(F.transform("_us", lambda e: e["u"])))
    kept = F.filter("_us", lambda e: (e["u"] < F.col("_keep")) | (e["u"] == F.col("_umin")))
    x = x.select(ID, "_p", "n", F.explode(kept).alias("_c")).select(ID, "_p", "n", F.col("_c.cut").alias("cut"))
    return x.withColumn("forecast_start", F.get("_p", F.col("cut"))[DS])


def window_arrays(cuts: DataFrame, context_length: int, h: int, nonempty: bool = False) -> DataFrame:
    """Rows of cuts with ``_p`` -> window_id, ``past`` and ``future`` as arrays.

    ``past`` is ``context_length`` structs (ds, y, is_pad), padded on the left;
    ``future`` the ``h`` points from the cut on.  With ``nonempty`` windows
    without an observed past value go.
    """
    c, k = int(context_length), F.least(F.col("cut"), F.lit(int(context_length)))
    point = lambda e, pad: F.struct(e[DS].alias(DS), e[Y].alias(Y), F.lit(pad).alias("is_pad"))
    none = F.struct(F.lit(None).cast("timestamp_ntz").alias(DS), F.lit(None).cast("double").alias(Y), F.lit(True).alias("is_pad"))
    own = F.transform(F.slice("_p", F.col("cut") - k + 1, k), lambda e: point(e, False))
    past = F.concat(F.array_repeat(none, F.lit(c) - k), own)
    future = F.transform(F.slice("_p", F.col("cut") + 1, int(h)), lambda e: point(e, False))
    out = cuts.select(ID, F.concat_ws("#", ID, F.col("cut").cast("string")).alias("window_id"), "forecast_start", "cut",
                      past.alias("past"), future.alias("future"))
    return out.where(F.exists("past", lambda e: e[Y].isNotNull())) if nonempty else out


def random_windows(df: DataFrame, min_past: int, context_length: int, h: int, num_instances: float = 1.0,
                   seed: int = 0, nonempty: bool = False) -> DataFrame:
    """``context_window`` of ``random_cut_split`` in one pass: series packed once and written, cuts and windows as arrays.

    The same rows as the two operators one after the other, without an
    exchange after the packing.
    """
    from tidecast.functions.materialize import materialize
    wins = window_arrays(packed_cuts(materialize(packed_points(df)), min_past, h, num_instances, seed), context_length, h, nonempty)
    both = F.concat("past", "future")
    # outer: a generator that drops empty arrays would evaluate the windows again in a filter on their size
    rows = wins.select(ID, "window_id", "forecast_start", "cut", F.posexplode_outer(both).alias("_i", "_e"))
    rows = rows.where(F.col("_i").isNotNull())
    rel = F.col("_i") - F.lit(int(context_length))
    return rows.select(ID, "window_id", "forecast_start", "cut", rel.cast("int").alias("rel"), F.col("_e")[DS].alias(DS),
                       F.col("_e")[Y].alias(Y), F.col("_e.is_pad").alias("is_pad"), (rel >= 0).alias("is_future"))


def eval_grid(src, dataset: str | None = None, offset: int | None = None, eval_length: int | None = None,
              horizons=(), contexts=(), patches=()) -> DataFrame:
    """Evaluation specs: every (horizon, context, patch) combination per
    dataset, with ``windows = eval_length div horizon`` and ``distance = horizon``.

    ``src`` is a SparkSession (then dataset/offset/eval_length are given) or
    a DataFrame with columns dataset, offset, eval_length (e.g. derived from
    the data).  The result is small: rows = datasets x |h| x |c| x |p|.
    """
    if isinstance(src, SparkSession):
        base = src.range(1).select(F.lit(dataset).alias("dataset"), F.lit(int(offset)).alias("offset"),
                                   F.lit(int(eval_length)).alias("eval_length"))
    else:
        base = src.select("dataset", "offset", "eval_length")
    arr = lambda xs: F.array(*[F.lit(int(v)) for v in xs])
    g = (base.select("*", F.explode(arr(horizons)).alias("prediction_length"))
             .select("*", F.explode(arr(contexts)).alias("context_length"))
             .select("*", F.explode(arr(patches)).alias("patch_size")))
    g = g.withColumn("windows", F.floor(F.col("eval_length") / F.col("prediction_length")).cast("int"))
    g = g.withColumn("distance", F.col("prediction_length"))
    return g.withColumn("spec_id", F.concat_ws(
        "/", "dataset", F.concat(F.lit("h"), F.col("prediction_length").cast("string")),
        F.concat(F.lit("c"), F.col("context_length").cast("string")),
        F.concat(F.lit("p"), F.col("patch_size").cast("string"))))


def rolling_eval_windows(df: DataFrame, specs: DataFrame, dataset: str | None = None) -> DataFrame:
    """Per series and spec: ``windows`` cuts ``distance`` apart starting at
    ``offset`` (negative = from the end), each with its context and future.
    Windows whose future runs past the series end are not produced.

    ``specs`` (dataset, spec_id, offset, windows, distance,
    prediction_length, context_length) stays a DataFrame: it meets the packed
    series in an equi-join on the dataset, so a series gets its own dataset's
    specs only.  A table without a ``dataset`` column belongs to ``dataset``,
    whose specs (parameter combinations) come in as one scalar subquery.
    """
    cols = ["dataset", "spec_id", "offset", "windows", "distance", "prediction_length", "context_length"]
    points = F.array_sort(F.collect_list(F.struct(DS, Y))).alias("_p")
    if "dataset" in df.columns:
        own = df.groupBy(ID).agg(F.first("dataset").alias("dataset"), points)
        c = own.withColumn("n", F.size("_p")).join(specs.select(*cols), "dataset")
    else:
        mine = specs.where(F.col("dataset") == dataset).agg(F.collect_list(F.struct(*cols))).scalar()
        c = df.groupBy(ID).agg(points).withColumn("n", F.size("_p")).withColumn("_all", mine)
        c = c.select(ID, "_p", "n", F.explode("_all").alias("_s")).select(ID, "_p", "n", "_s.*")
    c = c.select("*", F.explode(upto(F.lit(0), F.col("windows") - 1)).alias("window_no"))
    start = F.when(F.col("offset") >= 0, F.col("offset")).otherwise(F.col("n") + F.col("offset"))
    c = c.withColumn("cut", (start + F.col("window_no") * F.col("distance")).cast("int"))
    c = c.where((F.col("cut") >= 0) & (F.col("cut") + F.col("prediction_length") <= F.col("n")))
    c = c.withColumn("window_id", F.concat_ws("#", ID, "spec_id", F.col("window_no").cast("string")))
    return _expand(c, F.col("context_length"), F.col("prediction_length"), [ID, "spec_id", "window_no", "window_id"])


def nonempty_context(windows: DataFrame, key: str = "window_id") -> DataFrame:
    """Drop windows with no observed past value."""
    obs = F.count(F.when(~F.col("is_future"), F.col(Y))).over(Window.partitionBy(key))
    return windows.withColumn("_obs", obs).where(F.col("_obs") > 0).drop("_obs")


def patch_series(windows: DataFrame, patch_size: int, key: str = "window_id") -> DataFrame:
    """Cut each context (rel < 0) into patches of ``patch_size``, padding at
    the front so the last patch is full.  Adds ``patch`` and ``slot``;
    front padding rows have NULL ``y`` and ``is_pad``."""
    p = int(patch_size)
    ctx = windows.where(~F.col("is_future"))
    L = F.count(F.lit(1)).over(Window.partitionBy(key))
    ctx = ctx.withColumn("_L", L).withColumn("_pad", F.pmod(-F.col("_L"), F.lit(p)))
    # the first row of a window also emits the padding before it
    item = lambda i, ds, y, pad: F.struct(i.cast("int").alias("i"), ds.alias("ds"), y.alias("y"), pad.alias("is_pad"))
    own = F.array(item(F.col("rel") + F.col("_L") + F.col("_pad"), F.col(DS), F.col(Y), F.col("is_pad")))
    heads = F.transform(F.sequence(F.lit(0), F.col("_pad") - 1), lambda i: item(
        i, F.lit(None).cast("timestamp_ntz"), F.lit(None).cast("double"), F.lit(True)))
    rows = F.when((F.col("rel") == -F.col("_L")) & (F.col("_pad") > 0), F.concat(heads, own)).otherwise(own)
    x = ctx.select(key, F.explode(rows).alias("_r"))
    return x.select(key, F.floor(F.col("_r.i") / p).cast("int").alias("patch"),
                    F.pmod(F.col("_r.i"), F.lit(p)).cast("int").alias("slot"),
                    F.col("_r.ds").alias(DS), F.col("_r.y").alias(Y), F.col("_r.is_pad").alias("is_pad"))


def patch_mask(patches: DataFrame, lo: float = C.MASK_RATIO[0], hi: float = C.MASK_RATIO[1],
               min_patches: int = C.MIN_PATCHES,
               seed: int = 0, key: str = "window_id") -> DataFrame:
    """Per window draw a mask share r in [lo, hi]; the trailing
    ``max(1, round(n * r))`` of its n patches are targets.  Windows with fewer
    than ``min_patches`` patches are dropped.  One row per patch."""
    per = patches.groupBy(key, "patch").agg(F.count(Y).alias("n_obs"))
    n = F.count(F.lit(1)).over(Window.partitionBy(key))
    per = per.withColumn("n_patches", n).where(F.col("n_patches") >= min_patches)
    r = F.lit(lo) + F.lit(hi - lo) * uniform(seed, F.col(key))
    nt = F.greatest(F.lit(1), F.round(F.col("n_patches") * r).cast("int"))
    return per.withColumn("n_target", nt).withColumn(
        "is_target", F.col("patch") >= F.col("n_patches") - F.col("n_target"))


def fixed_context(packed: DataFrame, length: int = C.CONTEXT_LENGTH) -> DataFrame:
    """Last ``length`` values of each packed series; a shorter series is
    zero-padded on the *right* with a 0/1 ``mask`` (1 = real value).

    ``slice`` with a start before the array returns ``[]``, hence ``greatest``.
    """
    L = int(length)
    n = F.size(Y)
    ctx = F.slice(Y, F.greatest(n - L + 1, F.lit(1)), L)
    pad = F.greatest(F.lit(L) - n, F.lit(0))
    zeros = F.array_repeat(F.lit(0.0), pad)
    mask = F.concat(F.array_repeat(F.lit(1), F.least(n, F.lit(L))), F.array_repeat(F.lit(0), pad))
    return packed.select(ID, F.concat(ctx, zeros).alias("context"), mask.alias("mask"))

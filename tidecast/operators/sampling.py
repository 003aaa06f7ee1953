"""Sampling, mixing, shuffling, sharding, batching and packing (rows 45-50).

Positions come from ``global_position`` (range partitioning plus a prefix
sum over per-partition counts), never from a window without partitioning.
"""

from __future__ import annotations

from collections.abc import Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast import constants as C
from tidecast.functions.positions import global_position
from tidecast.functions.ranges import upto
from tidecast.functions.rng import hash_order, uniform
from tidecast.schema import ID
from tidecast.session import ship_package


def _choice(u, names, probs):
    """CASE expression picking names[i] when u falls in its cumulative slot."""
    total = float(sum(probs))
    if total <= 0:
        raise ValueError("probabilities must sum to > 0")
    expr, acc = None, 0.0
    for name, p in zip(names[:-1], probs[:-1]):
        acc += p / total
        expr = (F.when(u < F.lit(acc), F.lit(name)) if expr is None
                else expr.when(u < F.lit(acc), F.lit(name)))
    last = F.lit(names[-1])
    return last if expr is None else expr.otherwise(last)


def mixture_sample(df: DataFrame, probs: Mapping[str, float] | None, n_draws: int, seed: int = 0,
                   dataset_col: str = "dataset", salt: int = 16) -> DataFrame:
    """``n_draws`` draws: a dataset by its probability (uniform when none
    given, by ``mixtures.mixture_draws``), then a series uniformly within that
    dataset (with replacement).  For many datasets use ``mixture_draws``.

    Series are numbered per dataset by a distributed global position; the
    per-dataset offsets/counts table has one row per dataset (bounded by the
    probability list) and is broadcast; the draw is an equi-join on
    (dataset, index).  A likely dataset with few series sends most draws to
    a handful of keys, so the join is salted: draws carry ``draw mod salt``
    and the (small, one row per series) lookup side is replicated ``salt``
    times, spreading a hot key over ``salt`` tasks.
    """
    spark = df.sparkSession
    if probs is None:
        from tidecast.operators.mixtures import mixture_draws
        return mixture_draws(df, None, n_draws, seed, dataset_col, salt=salt)
    ids = df.select(dataset_col, ID).distinct()
    names = list(probs)
    numbered = global_position(ids.where(F.col(dataset_col).isin(names)), [dataset_col, ID], "_gpos")
    meta = numbered.groupBy(dataset_col).agg(F.min("_gpos").alias("_first"), F.count(F.lit(1)).alias("_cnt"))
    numbered = numbered.join(F.broadcast(meta), dataset_col).select(
        dataset_col, ID, (F.col("_gpos") - F.col("_first")).alias("_idx"))
    draws = spark.range(int(n_draws)).withColumnRenamed("id", "draw")
    draws = draws.withColumn(dataset_col, _choice(uniform(seed, F.col("draw"), "ds"),
                                                  names, [float(probs[n]) for n in names]))
    draws = draws.join(F.broadcast(meta), dataset_col)
    draws = draws.withColumn("_idx", F.floor(uniform(seed, F.col("draw"), "s") * F.col("_cnt")).cast("long"))
    k = max(1, int(salt))
    draws = draws.withColumn("_salt", F.pmod(F.col("draw"), F.lit(k)).cast("int"))
    numbered = numbered.select("*", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_salt"))
    return draws.join(numbered, [dataset_col, "_idx", "_salt"]).select("draw", dataset_col, ID)


def weight_repeat(df: DataFrame, weights: Mapping[str, int], dataset_col: str = "dataset") -> DataFrame:
    """Repeat each dataset's rows ``weight`` times (column ``copy`` = 1..w);
    datasets not named keep weight 1, weight 0 leaves a dataset out."""
    w = F.lit(1)
    expr = None
    for name, k in weights.items():
        expr = (F.when(F.col(dataset_col) == name, F.lit(int(k))) if expr is None
                else expr.when(F.col(dataset_col) == name, F.lit(int(k))))
    if expr is not None:
        w = expr.otherwise(F.lit(1))
    return df.select("*", F.explode(upto(F.lit(1), w)).alias("copy"))


def global_shuffle(df: DataFrame, seed: int, key_cols=(ID,), name: str = "position") -> DataFrame:
    """A seeded random total order with a 0-based ``position``.

    Order = (md5(seed:key), key): deterministic, so a lost task recomputes
    the same positions.
    """
    keys = [F.col(k) for k in key_cols]
    x = df.withColumn("_h", hash_order(seed, *keys))
    return global_position(x, [F.col("_h"), *keys], name).drop("_h")


def _cyclic(df: DataFrame, total, position: str):
    """Rows at slots q, q+n, q+2n, ... below ``total`` (n = row count)."""
    n = df.select(F.count(F.lit(1))).scalar()
    q = F.col(position)
    kmax = F.floor((total - 1 - q) / n)
    out = df.where(q < total).select("*", F.explode(F.sequence(F.lit(0).cast("long"), kmax.cast("long"))).alias("copy"))
    return out.withColumn("_slot", F.col(position) + F.col("copy") * n), n


def shard_assign(df: DataFrame, world_size: int, drop_last: bool = False,
                 position: str = "position") -> DataFrame:
    """Assign ordered rows to ``world_size`` ranks with equal shard sizes:
    slot s goes to rank ``s mod world``.  Without ``drop_last`` the tail is
    padded with copies from the head (wrap-around); with it, the remainder
    is dropped."""
    w = int(world_size)
    n = df.select(F.count(F.lit(1))).scalar()
    total = (F.floor(n / w) * w) if drop_last else (F.ceil(n / w) * w)
    out, _ = _cyclic(df, total, position)
    return (out.withColumn("rank", F.pmod(F.col("_slot"), F.lit(w)).cast("int"))
               .withColumn("rank_index", F.floor(F.col("_slot") / w).cast("long"))
               .drop("_slot"))


def batch_assign(df: DataFrame, batch_size: int, steps: int | None = None,
                 position: str = "position") -> DataFrame:
    """Group ordered rows into batches of ``batch_size``.  With ``steps``,
    exactly ``steps`` full batches are produced, cycling over the data when it
    is shorter than ``steps * batch_size``."""
    b = int(batch_size)
    if steps is None:
        return df.withColumn("batch", F.floor(F.col(position) / b).cast("long")).withColumn(
            "batch_slot", F.pmod(F.col(position), F.lit(b)).cast("int")).withColumn("copy", F.lit(0).cast("long"))
    out, _ = _cyclic(df, F.lit(int(steps) * b).cast("long"), position)
    return (out.withColumn("batch", F.floor(F.col("_slot") / b).cast("long"))
               .withColumn("batch_slot", F.pmod(F.col("_slot"), F.lit(b)).cast("int")).drop("_slot"))


def _next_fit(max_length: int):
    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("key", kind="mergesort")
        bins, offs = [], []
        b, fill = 0, 0
        first = True
        for ln in pdf["length"].to_numpy():
            ln = int(ln)
            if not first and fill + ln > max_length:
                b, fill = b + 1, 0
            bins.append(b)
            offs.append(fill)
            fill += ln
            first = False
        return pd.DataFrame({"key": pdf["key"].to_numpy(), "shard": pdf["shard"].to_numpy(),
                             "bin": bins, "offset": offs, "length": pdf["length"].to_numpy()})
    return fit


def pack_sequences(seqs: DataFrame, key: str, length: str, shards: int, max_length: int = C.PACK_LENGTH) -> DataFrame:
    """Place variable-length sequences into bins of ``max_length`` slots,
    never splitting one.  A sequence longer than a bin is placed alone in a bin
    of its own, with ``oversize`` = true.

    Sequences are hashed to ``shards`` groups and each group is packed by
    next-fit in key order (a sequential fold, so it runs in ``applyInPandas``
    on (key, length) metadata only).  The caller's shard count sets the
    parallelism/fill trade-off and, with the keys, the result; no session
    setting does.
    """
    spark = seqs.sparkSession
    ship_package(spark)
    x = seqs.select(F.col(key).cast("string").alias("key"), F.col(length).cast("long").alias("length"))
    k = int(shards)
    # shard = first 32 bits of md5(key) mod k: stable across engines and versions
    h = F.conv(F.substring(F.md5(F.col("key")), 1, 8), 16, 10).cast("long")
    x = x.withColumn("shard", F.pmod(h, F.lit(k)).cast("int"))
    out = x.groupBy("shard").applyInPandas(
        _next_fit(int(max_length)), "key string, shard int, bin long, offset long, length long")
    return out.withColumn("bin_id", F.concat_ws(":", F.col("shard").cast("string"), F.col("bin").cast("string"))) \
        .withColumn("oversize", F.col("length") > int(max_length))

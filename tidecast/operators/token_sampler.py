"""Sample paths of tokens from counted transitions (rows 56, 60).

How often each token follows each other one, over all series, is a sparse
table of counts; a path starts at a series' last token and draws every next
token from the current one's counts.  ``token_decode`` turns paths into values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidecast.functions.calendar import add_steps
from tidecast.functions.materialize import materialize
from tidecast.functions.ranges import positive
from tidecast.functions.rng import uniform
from tidecast.schema import DS, ID


def token_transitions(tokens: DataFrame, token: str = "token") -> DataFrame:
    """(token, next, c): how often ``next`` follows ``token`` in a series, over all series.

    Rows without a token take no part: the tokens before and after one are
    neighbours.  The table has at most one row a pair of tokens that occurs.
    """
    w = Window.partitionBy(ID).orderBy(DS, token)
    pairs = tokens.where(F.col(token).isNotNull()).select(F.col(token).alias("token"), F.lead(token).over(w).alias("next"))
    return pairs.where("next IS NOT NULL").groupBy("token", "next").agg(F.count(F.lit(1)).alias("c"))


def _first_above(upto, k):
    """1-based place of the first of the rising numbers ``upto`` that is above ``k``, by halving."""
    start = F.struct(F.lit(1).alias("lo"), F.size(upto).alias("hi"))

    def halve(acc, _):
        mid = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        below = F.element_at(upto, mid) > k
        return F.struct(F.when(below, acc["lo"]).otherwise(mid + 1).alias("lo"),
                        F.when(below, mid).otherwise(acc["hi"]).alias("hi"))

    rounds = F.sequence(F.lit(1), F.ceil(F.log2(F.size(upto).cast("double"))).cast("int") + 1)
    return F.aggregate(rounds, start, halve)["lo"]


def sample_token_paths(tokens: DataFrame, h: int, num_samples: int, seed: int = 0, freq: str = "D",
                       transitions: DataFrame | None = None, token: str = "token", salt: int = 8) -> DataFrame:
    """(unique_id, sample, step, ds, token): ``num_samples`` paths of ``h`` tokens after every series' last token.

    ``transitions`` are those of ``tokens`` unless others are given.  A draw
    depends on (seed, series, sample, step) alone, so any partitioning and any
    retry gives the same paths.  A token that nothing follows is followed by
    itself; a series without a token has no path; an empty table gives no rows.

    Every token's successors are one row of cumulative counts (at most as long
    as the vocabulary), and each step is one equi-join with these rows.  Paths
    at a frequent token are spread over ``salt`` copies of its row; whether
    the rows are broadcast is decided by their measured size.
    """
    h, n, copies = positive("h", h), positive("num_samples", num_samples), positive("salt", salt)
    counts = token_transitions(tokens, token) if transitions is None else transitions
    upto = F.sum("c").over(Window.partitionBy("token").orderBy("next"))
    rows = counts.select("token", F.struct(F.col("next"), upto.alias("upto")).alias("e")).groupBy("token") \
        .agg(F.array_sort(F.collect_list("e")).alias("e")) \
        .select(F.col("token").alias("_t"), F.col("e.next").alias("_next"), F.col("e.upto").alias("_upto"))
    rows = materialize(rows).select("*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("_copy"))
    last = tokens.groupBy(ID).agg(F.max(DS).alias("_last"), F.max_by(F.col(token), F.when(
        F.col(token).isNotNull(), F.struct(F.col(DS), F.col(token)))).alias("_t")).where("_t IS NOT NULL")
    paths = last.select("*", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("sample"), F.array().cast("array<int>").alias("_path"))
    paths = paths.withColumn("_copy", F.pmod(F.xxhash64(ID, "sample"), F.lit(copies)).cast("int"))
    for k in range(1, h + 1):
        met = paths.join(rows, ["_t", "_copy"], "left")
        draw = F.floor(uniform(seed, F.col(ID), F.col("sample"), k) * F.element_at("_upto", -1))
        met = met.withColumn("_to", F.when(F.col("_upto").isNull(), F.col("_t")).otherwise(
            F.element_at("_next", _first_above(F.col("_upto"), draw))).cast("int"))
        paths = met.select(ID, "_last", F.col("_to").alias("_t"), "sample", F.array_append("_path", F.col("_to")).alias("_path"), "_copy")
    out = paths.select(ID, "_last", "sample", F.posexplode("_path").alias("_p", "token"))
    step = F.col("_p") + 1
    return out.select(ID, F.col("sample").cast("int").alias("sample"), step.cast("int").alias("step"),
                      add_steps(F.col("_last"), step, freq).alias(DS), "token")

"""Mixture draws from an alias table (row 45 for any number of datasets).

Every bucket of an alias table holds at most two datasets, so a draw is one
bucket and one comparison, however many datasets there are.  The table is
built by prefix sums: datasets lighter than the average lie with what they
lack on one line, heavier ones with what they have too much on another of the
same length, and where the two lines meet tells who fills whose bucket.  No
name and no weight comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.functions.materialize import materialize
from tidecast.functions.positions import global_position, global_sums
from tidecast.functions.ranges import positive
from tidecast.functions.rng import uniform
from tidecast.schema import ID

#: Weights become whole numbers, the greatest one this; sums are then exact in any order.
SCALE = 1 << 30
_WIDE = "decimal(38,0)"


def alias_table(weights: DataFrame, name: str = "dataset", weight: str = "weight") -> DataFrame:
    """(bucket, name, keep, alias, full, parts, units): bucket b gives ``name`` for the first ``keep`` of ``full``, then ``alias``.

    ``units`` is the dataset's whole-number weight, ``parts`` the number of
    buckets; ``keep`` and ``full`` are in units of 1 / ``parts``.  Rows without
    a name, or without a positive finite weight, take no part; rows of one name
    count with the sum of their weights; a weight below the greatest one by
    more than ``SCALE`` counts as one unit.  Sums are kept to 12 decimals and
    below 1e26; give weights in that range.  An empty table gives no rows.
    """
    w = F.col(weight).cast("double")
    good = F.col(name).isNotNull() & (w > 0) & ~F.isnan(w) & (w < float("inf"))
    # exact sums, so that no order of rows can change a weight
    sums = materialize(weights.where(good).groupBy(F.col(name).alias("_name")).agg(F.sum(w.cast("decimal(38,12)")).alias("_w")))
    top = sums.select(F.max("_w").cast("double")).scalar()
    units = F.greatest(F.lit(1), F.floor(F.col("_w").cast("double") / top * SCALE)).cast("long")
    ints = sums.select("_name", units.alias("_i"))
    full, parts = ints.select(F.sum("_i")).scalar(), ints.select(F.count(F.lit(1))).scalar()
    gap = full.cast(_WIDE) - (F.col("_i").cast("decimal(19,0)") * parts.cast("decimal(19,0)")).cast(_WIDE)
    line = ints.select("_name", "_i", full.alias("_full"), parts.alias("_parts"), gap.cast(_WIDE).alias("_gap"))
    line = line.withColumn("_heavy", F.col("_gap") < 0)
    none = F.lit(0).cast(_WIDE)
    line = global_sums(line, ["_name"], {
        "_lack": F.when(F.col("_heavy"), none).otherwise(F.col("_gap")), "_over": F.when(F.col("_heavy"), -F.col("_gap")).otherwise(none),
        "_light_no": F.when(F.col("_heavy"), 0).otherwise(1).cast("long"), "_heavy_no": F.when(F.col("_heavy"), 1).otherwise(0).cast("long")})
    line = line.withColumn("bucket", F.col("_light_no") + F.col("_heavy_no") - 1)
    size = F.abs("_gap")
    end = F.when(F.col("_heavy"), F.col("_over")).otherwise(F.col("_lack"))
    # at one place: a heavy one begins before a light one does, and ends before a light one does
    at = F.array(F.struct((end - size).cast(_WIDE).alias("pos"), F.when(F.col("_heavy"), 0).otherwise(1).alias("rank")),
                 F.struct(end.cast(_WIDE).alias("pos"), F.when(F.col("_heavy"), 2).otherwise(3).alias("rank")))
    events = line.select("*", F.explode(at).alias("_e")).select("*", "_e.pos", "_e.rank").drop("_e")
    met = global_sums(events, ["pos", "rank", "_name"], {
        "_begun": (F.col("rank") == 0).cast("long"), "_filled": (F.col("rank") == 3).cast("long")})
    # a light one is filled by the heavy one it begins at; a heavy one, once it has given too much, by the next heavy one
    buckets = met.where("rank IN (1, 2)").select(
        "bucket", "_name", "_i", "_full", "_parts", "_heavy", "_over",
        F.when(F.col("_heavy"), F.col("_heavy_no") + 1).otherwise(F.col("_begun")).alias("_to"),
        F.when(F.col("_heavy"), F.col("_filled") + 1).alias("_by"))
    heavy = line.where("_heavy").select(F.col("_heavy_no").alias("_to"), F.col("_name").alias("_alias"))
    light = line.where("NOT _heavy").select(F.col("_light_no").alias("_by"), F.col("_lack").alias("_given"))
    out = buckets.join(heavy, "_to", "left").join(light, "_by", "left")
    own = (F.col("_i").cast("decimal(19,0)") * F.col("_parts").cast("decimal(19,0)")).cast(_WIDE)
    keep = F.when(F.col("_heavy"), F.col("_full").cast(_WIDE) + F.col("_over") - F.col("_given")).otherwise(own)
    return out.select("bucket", F.col("_name").alias(name), keep.cast(_WIDE).alias("keep"),
                      F.coalesce("_alias", "_name").alias("alias"), F.col("_full").alias("full"),
                      F.col("_parts").alias("parts"), F.col("_i").alias("units"))


def mixture_draws(df: DataFrame, weights: DataFrame | None, n_draws: int, seed: int = 0, dataset_col: str = "dataset",
                  weight: str = "weight", salt: int = 16) -> DataFrame:
    """(draw, dataset, unique_id): ``n_draws`` draws of a dataset by its weight, then of one of its series, with replacement.

    ``weights`` has a row (dataset, weight) for each dataset; None weighs all
    alike.  Datasets without a series take no part; an empty table gives no
    rows.  A draw depends on (seed, draw) and the table's content alone.  Both
    joins are equi-joins on (bucket or series, salt): draws of a likely dataset
    meet ``salt`` copies of its row.
    """
    n, k = positive("n_draws", n_draws), positive("salt", salt)
    ids = df.select(dataset_col, ID).where(F.col(dataset_col).isNotNull()).distinct()
    numbered = materialize(global_position(ids, [dataset_col, ID], "_gpos"))
    meta = numbered.groupBy(dataset_col).agg(F.min("_gpos").alias("_first"), F.count(F.lit(1)).alias("_cnt"))
    share = meta.select(dataset_col, F.lit(1.0).alias(weight)) if weights is None else \
        weights.select(dataset_col, weight).join(meta.select(dataset_col), dataset_col, "left_semi")
    table = alias_table(share, dataset_col, weight)
    table = table.join(meta.select(dataset_col, "_first", "_cnt"), dataset_col) \
        .join(meta.select(F.col(dataset_col).alias("alias"), F.col("_first").alias("_first2"), F.col("_cnt").alias("_cnt2")), "alias")
    copies = F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_salt")
    table = materialize(table)
    parts = table.select(F.max("parts")).scalar()
    draw = F.col("draw")
    draws = df.sparkSession.range(n).withColumnRenamed("id", "draw") \
        .withColumn("bucket", F.floor(uniform(seed, draw, "bucket") * parts).cast("long")) \
        .withColumn("_salt", F.pmod(draw, F.lit(k)).cast("int"))
    met = draws.join(table.select("*", copies), ["bucket", "_salt"])
    own = uniform(seed, draw, "keep") * F.col("full").cast("double") < F.col("keep").cast("double")
    of = lambda mine, other: F.when(own, F.col(mine)).otherwise(F.col(other))
    met = met.select("draw", "_salt", of(dataset_col, "alias").alias(dataset_col), of("_first", "_first2").alias("_first"),
                     of("_cnt", "_cnt2").alias("_cnt"))
    met = met.withColumn("_gpos", F.col("_first") + F.floor(uniform(seed, draw, "s") * F.col("_cnt")).cast("long"))
    series = numbered.select("_gpos", ID, copies)
    return met.join(series, ["_gpos", "_salt"]).select("draw", dataset_col, ID)

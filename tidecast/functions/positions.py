"""Row positions.

* ``series_position``: 0-based position inside each series (window partitioned
  by ``unique_id``; a series is bounded by its calendar span).
* ``global_position``: 0-based position in a total order over the whole table
  **without** an unpartitioned window (which would pull every row into one
  task).  Range-partition on the order key, number rows inside each partition,
  and add the prefix sum of the per-partition counts.  The counts table has one
  row per partition, so broadcasting it is bounded by the partition count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.functions.materialize import materialize
from tidecast.schema import DS, ID, Y


def series_position(df: DataFrame, name: str = "pos", order: str = DS,
                    desc: bool = False, by: Sequence[str] = (ID,)) -> DataFrame:
    """0-based position of each row inside its series (``desc`` counts from the end)."""
    o = F.col(order).desc() if desc else F.col(order).asc()
    # points of one series at one time are put in the order of their values
    ties = [F.col(Y).desc() if desc else F.col(Y).asc()] if Y in df.columns and order != Y else []
    w = Window.partitionBy(*by).orderBy(o, *ties)
    return df.withColumn(name, (F.row_number().over(w) - 1).cast("int"))


def global_position(df: DataFrame, order: Sequence[Column | str], name: str = "position",
                    num_partitions: int | None = None) -> DataFrame:
    """Attach a dense 0-based position following ``order``.

    ``order`` must be a total order (unique per row) so recomputation after an
    executor loss numbers rows identically.

    The counts and the numbered rows must see the *same* range partitioning,
    whatever other columns ``df`` has.  Two range exchanges may sample
    different bounds, so the range-partitioned rows are written once to the
    shared checkpoint folder, and both the counts and the numbers are read
    from there: one range exchange, and no dependence on exchange reuse.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = (df.repartitionByRange(n, *cols)
                .sortWithinPartitions(*cols)
                .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = materialize(ranged.withColumn("_part", F.shiftright(F.col("_mid"), 33)))
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = counts.select(
        "_part",
        (F.sum("_cnt").over(Window.orderBy("_part")) - F.col("_cnt")).alias("_off"))
    out = ranged.join(F.broadcast(offsets), "_part")
    local = F.col("_mid") - F.shiftleft(F.col("_part"), 33)
    return out.withColumn(name, (F.col("_off") + local).cast("long")).drop("_mid", "_part", "_off")


def global_sums(df: DataFrame, order: Sequence[Column | str], sums: Mapping[str, Column],
                num_partitions: int | None = None) -> DataFrame:
    """Attach inclusive running sums over a total order of the whole table, one column for each of ``sums``.

    Same plan as ``global_position``: one range exchange, written once;
    running sums inside each range plus the sums of the ranges before it.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = (df.withColumns(dict(sums)).repartitionByRange(n, *cols).sortWithinPartitions(*cols)
                .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = materialize(ranged.withColumn("_part", F.shiftright(F.col("_mid"), 33)))
    totals = ranged.groupBy("_part").agg(*[F.sum(c).alias(c) for c in sums])
    ahead = totals.select("_part", *[(F.sum(c).over(Window.orderBy("_part")) - F.col(c)).alias(f"_ahead_{k}")
                                     for k, c in enumerate(sums)])
    run = Window.partitionBy("_part").orderBy("_mid").rowsBetween(Window.unboundedPreceding, 0)
    out = ranged.withColumns({c: F.sum(c).over(run) for c in sums}).join(F.broadcast(ahead), "_part")
    return out.withColumns({c: F.col(c) + F.col(f"_ahead_{k}") for k, c in enumerate(sums)}) \
        .drop("_mid", "_part", *[f"_ahead_{k}" for k in range(len(sums))])

"""Sequence packing from a histogram of lengths (row 50).

How many sequences there are of each length decides which combinations of
lengths fill a bin; the rows are then dealt to the combinations' slots by
their distributed positions.  The state on the driver is one count per length,
no row is folded in Python, and neither shards nor partitions change the bins.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast import constants as C
from tidecast.functions.positions import global_position


def bin_patterns(counts: Mapping[int, int], max_length: int) -> list[tuple[dict[int, int], int]]:
    """(pattern, times) that use up ``counts``: a pattern says how often each length stands in one bin.

    A pattern begins with the greatest length left and takes, from greatest to
    least, what fits and is left; it is used as often as the counts allow, so
    there are about as many patterns as lengths.
    """
    left = {n: c for n, c in sorted(counts.items(), reverse=True) if c > 0}
    out = []
    while left:
        pattern: dict[int, int] = {}
        room = max_length
        for n, c in left.items():
            if n > room and pattern:
                continue
            take = 1 if n > max_length else min(c, room // n if n else c)
            if take:
                pattern[n] = take
                room -= take * n
            if room <= 0:
                break
        times = min(left[n] // k for n, k in pattern.items())
        out.append((pattern, times))
        left = {n: c - times * pattern.get(n, 0) for n, c in left.items() if c > times * pattern.get(n, 0)}
    return out


def pack_by_lengths(seqs: DataFrame, key: str, length: str, max_length: int = C.PACK_LENGTH) -> DataFrame:
    """(key, length, bin, offset, oversize): sequences in bins of ``max_length`` slots, never splitting one.

    A sequence longer than a bin is alone in a bin of its own (``oversize``).
    Sequences of one length are dealt in the order of their keys (repeated
    keys are sequences of their own).  At most one histogram row per length up
    to ``max_length`` comes to the driver; longer sequences are counted as one.
    Sequences without a length, or of length below 1, are refused.
    """
    spark = seqs.sparkSession
    top = int(max_length)
    n = F.col(length).cast("long")
    x = seqs.select(F.col(key).cast("string").alias("key"), n.alias("length"),
                    F.when(n <= top, n).when(n > top, F.lit(top + 1)).alias("_class"))
    counts = {r[0]: r[1] for r in x.groupBy("_class").count().collect()}
    if any(k is None or k < 1 for k in counts):
        raise ValueError("every sequence needs a length of at least 1")
    # where each length's sequences go: (first place, of a pattern; sequences a bin; first bin; first offset)
    slots: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    base = 0
    for pattern, times in bin_patterns(counts, top):
        offset = 0
        for size, k in pattern.items():
            slots.setdefault(size, []).append((used.get(size, 0), k, base, offset))
            used[size] = used.get(size, 0) + k * times
            offset += size * k
        base += times
    # one row per length: bounded by max_length
    table = spark.createDataFrame([(s, v) for s, v in slots.items()],
                                  "_class long, slots array<struct<first:long,each:long,bin:long,offset:long>>")
    # repeated keys are told apart before positions are dealt
    placed = global_position(x.withColumn("_tie", F.monotonically_increasing_id()), ["_class", "length", "key", "_tie"], "_pos")
    first = placed.groupBy("_class").agg(F.min("_pos").alias("_first"))
    j = placed.join(F.broadcast(first.join(table, "_class")), "_class").withColumn("_k", F.col("_pos") - F.col("_first"))
    mine = F.element_at(F.filter("slots", lambda s: s["first"] <= F.col("_k")), -1)
    j = j.withColumn("_s", mine).withColumn("_i", F.col("_k") - F.col("_s.first"))
    return j.select("key", "length", (F.col("_s.bin") + F.floor(F.col("_i") / F.col("_s.each"))).cast("long").alias("bin"),
                    (F.col("_s.offset") + F.pmod("_i", F.col("_s.each")) * F.least("length", F.lit(top))).cast("long").alias("offset"),
                    (F.col("length") > top).alias("oversize"))

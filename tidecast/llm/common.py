"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.functions.materialize import materialize
from tidecast.session import ensure_checkpoint_dir, scratch_path, ship_package

__all__ = ["BATCH_BYTES", "blocks_of", "columns_of", "documents", "ensure_checkpoint_dir", "fresh", "held_out",
           "materialize", "prepare", "scratch_path", "stored", "train_rows", "utf8"]

#: Rows of whole texts go to Python in Arrow batches of at most this many bytes.
ARROW_BYTES = 8 << 20
#: Numpy work inside a task goes over at most so many bytes of text at once (one text may be longer).
BATCH_BYTES = 1 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Make this package importable on executors and bound the bytes of an Arrow batch."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Like a reliable checkpoint, but columnar: later reads prune columns.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def columns_of(df: DataFrame) -> list["F.Column"]:
    """All columns of ``df``, whatever signs their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def fresh(df: DataFrame, *names: str) -> list[str]:
    """For each of ``names`` a name that no column of ``df`` has."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        out.append(n)
    return out


def held_out(doc_id) -> "F.Column":
    """True for the rows that no classifier learns from: crc32(doc_id as text) mod 5 is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train_rows(docs: DataFrame, labels: DataFrame, label: str, rows: int, max_chars: int,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(text, label) of a bounded sample of the labelled rows outside the held-out fold.

    At most ``rows`` rows of each label value, in the order of a hash of the
    id, and only texts of at most ``max_chars`` characters: so the sample is
    bounded by 2 * rows * max_chars whatever the corpus holds.  Rows with a
    null id or label take no part; of several labels for an id the largest
    counts, of several texts the smallest, so a repeated id adds no rows.
    """
    lab = (labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("label"))
           .where("_id IS NOT NULL AND label IN (0, 1)").where(~held_out(F.col("_id")))
           .groupBy("_id").agg(F.max("label").alias("label")))
    text = docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    # ids only until the sample is known; the texts join the sample afterwards
    ids = text.where(F.length("text") <= max_chars).select("_id").join(lab, "_id")
    order = [F.xxhash64("_id"), F.col("_id")]
    picked = [ids.where(F.col("label") == v).dropDuplicates(["_id"]).orderBy(*order).limit(rows) for v in (0, 1)]
    sample = picked[0].unionByName(picked[1])
    return text.where(F.length("text") <= max_chars).join(F.broadcast(sample), "_id").groupBy("_id").agg(
        F.min("text").alias("text"), F.first("label").alias("label"))


def utf8(texts) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    return [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in texts]


def blocks_of(lengths, limit: int = BATCH_BYTES) -> Iterator[slice]:
    """Slices of consecutive rows with at most ``limit`` bytes each (one row may be longer)."""
    lo, total = 0, 0
    for i, n in enumerate(lengths):
        if i > lo and total + n > limit:
            yield slice(lo, i)
            lo, total = i, 0
        total += n
    if lo < len(lengths):
        yield slice(lo, len(lengths))


def ragged_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of start..start+length-1 for each row."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(np.asarray(starts, np.int64) - first, lengths)

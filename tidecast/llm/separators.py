"""Token counts by a separator scan over flat, unindexed token files (operator 10).

A flat file is a run of blocks of token ids without any index; documents end
with an end-of-document id and may span blocks.  Each block is searched for
that id with one vectorised comparison; documents that cross block borders
are put together by a prefix scan over one short row per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidecast.llm.common import blocks_of, prepare, stored
from tidecast.llm.tokens import chunked

#: Token ids of a block.
BLOCK_IDS = 1 << 17


def write_flat(docs: DataFrame, path: str, end_id: int, keeps_space: bool = True, block_ids: int = BLOCK_IDS,
               id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Flat token files of every row's whole text, each text followed by ``end_id``.

    Returns (blocks, order): blocks has file, block, payload and itemsize, and
    nothing that tells where documents begin; order has file, ordinal and
    doc_id, for naming the counted documents afterwards.  Each task writes one
    file.  Null texts count as empty.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tok = chunked(path, keeps_space)
        end = np.array([end_id], tok.dtype).tobytes()
        file, block, held, seen = TaskContext.get().partitionId(), 0, bytearray(), 0
        width = block_ids * tok.dtype.itemsize

        def row(payload, keys, at, gone):
            return pd.DataFrame([(file, block, payload, tok.dtype.itemsize, keys, gone, at)],
                                columns=["file", "block", "payload", "itemsize", "docs", "gone", "first"])

        for b in batches:
            texts = [t if isinstance(t, str) else "" for t in b["text"]]
            for part in blocks_of(list(map(len, texts))):
                held += b"".join([x + end for x in tok.encode(texts[part])])
                while len(held) >= width:
                    yield row(bytes(held[:width]), None, None, None)
                    del held[:width]
                    block += 1
            yield row(None, b["doc_id"].to_numpy().tobytes(), seen, b["gone"].to_numpy().tobytes())
            seen += len(b)
        if held:
            yield row(bytes(held), None, None, None)

    key = F.col(id_col).cast("bigint")
    rows = docs.select(F.coalesce(key, F.lit(0)).alias("doc_id"), key.isNull().alias("gone"), F.col(text_col).alias("text"))
    files = stored(rows.mapInPandas(run, "file int, block int, payload binary, itemsize int, docs binary, "
                                         "gone binary, first bigint"), "flat-tokens")

    def names(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples(index=False):
                keys = pd.array(np.frombuffer(r.docs, np.int64), "Int64")
                keys[np.frombuffer(r.gone, bool)] = pd.NA
                yield pd.DataFrame({"file": r.file, "ordinal": int(r.first) + np.arange(len(keys)), "doc_id": keys})

    order = (files.where("docs IS NOT NULL").select("file", "docs", "gone", "first")
             .mapInPandas(names, "file int, ordinal bigint, doc_id bigint"))
    return files.where("payload IS NOT NULL").select("file", "block", "payload", "itemsize"), order


def scan(blocks: DataFrame, end_id: int) -> DataFrame:
    """(file, ordinal, start, n_tokens, closed) of every document in the blocks of flat files.

    ``n_tokens`` excludes the separator, ``start`` counts the ids of the file
    before the document.  What follows the last separator of a file is one
    more row, with closed = false.  Empty payloads, files without a separator
    and documents over many blocks are allowed; a null payload is an empty one.
    The scan's windows run over one row per block.
    """
    prepare(blocks.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                ids = np.frombuffer(r.payload or b"", f"<u{int(r.itemsize)}")
                at = np.flatnonzero(ids == end_id)
                out.append((r.file, r.block, len(ids), len(at), int(at[-1]) + 1 if len(at) else None, at.astype(np.int32)))
            yield pd.DataFrame(out, columns=["file", "block", "n", "ends", "after", "at"])

    found = stored(blocks.select("file", "block", "payload", "itemsize").mapInPandas(
        run, "file int, block int, n bigint, ends bigint, after bigint, at array<int>"), "separators")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    short = found.select("file", "block", "n", "ends", "after").withColumn(
        "base", F.coalesce(F.sum("n").over(before), F.lit(0))).withColumn(
        "first", F.coalesce(F.sum("ends").over(before), F.lit(0)))
    short = short.withColumn("open", F.coalesce(F.max(F.col("base") + F.col("after")).over(before), F.lit(0)))
    ends = found.where("ends > 0").select("file", "block", "at").join(
        short.select("file", "block", "base", "first", "open"), ["file", "block"])
    placed = ends.select("file", "base", "first", "open", "at", F.posexplode("at").alias("k", "p"))
    start = F.when(F.col("k") == 0, F.col("open")).otherwise(F.col("base") + F.get("at", F.col("k") - 1) + 1)
    closed = placed.select("file", (F.col("first") + F.col("k")).alias("ordinal"), start.alias("start"),
                           (F.col("base") + F.col("p") - start).alias("n_tokens"), F.lit(True).alias("closed"))
    last = short.groupBy("file").agg(F.sum("n").alias("n"), F.sum("ends").alias("ordinal"),
                                     F.coalesce(F.max(F.col("base") + F.col("after")), F.lit(0)).alias("start"))
    rest = last.where("n > start").select("file", "ordinal", "start", (F.col("n") - F.col("start")).alias("n_tokens"),
                                          F.lit(False).alias("closed"))
    return closed.unionByName(rest)


def token_counts(docs: DataFrame, path: str, end_id: int, keeps_space: bool = True, id_col: str = "doc_id",
                 text_col: str = "text", block_ids: int = BLOCK_IDS) -> DataFrame:
    """(doc_id, n_tokens) of every row, counted in flat token files that are written for it.

    Repeated rows are counted each; null texts have 0 tokens; an empty table gives no rows.
    """
    blocks, order = write_flat(docs, path, end_id, keeps_space, block_ids, id_col, text_col)
    return order.join(scan(blocks, end_id), ["file", "ordinal"]).select("doc_id", "n_tokens")

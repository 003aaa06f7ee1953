"""Huffman-coded token files in independent blocks (operator 5).

The ids of all documents are counted once over the whole corpus and coded
with one canonical, length-limited Huffman code.  A file part is a run of
blocks in ascending doc_id order; a block holds whole documents and can be
read by itself: its header has the documents' ids and lengths and the bit
offset of every 256th symbol.  Reading walks all these checkpoints of a block
in step through one decoding table.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidecast.llm.common import blocks_of, prepare, scratch_path, stored
from tidecast.llm.tokens import chunked

#: Longest code in bits; the decoding table has 2 ** MAX_BITS entries.
MAX_BITS = 20
#: Symbols between checkpoints.
STRIDE = 256
#: Tokens of a block, about; one document may have more.
BLOCK_TOKENS = 1 << 17
#: Tokens of a run between encoding and sorting, about: rows small enough for the JVM's ordinary heap regions.
RUN_TOKENS = 1 << 17
#: Characters of text of one file part, about.
PART_CHARS = 12_000_000


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code length of each symbol under ``limit`` bits, 0 where the count is 0 (package-merge)."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        out[used] = 1
        return out
    if len(used) > 1 << limit:
        raise ValueError("more symbols than codes")
    order = used[np.argsort(counts[used], kind="stable")]
    leaf = counts[order].astype(np.float64)
    n = len(leaf)
    kinds, level = [], leaf
    is_leaf = np.ones(n, bool)
    for _ in range(limit - 1):
        kinds.append(is_leaf)
        pairs = level[:len(level) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([leaf, pairs])
        at = np.argsort(both, kind="stable")
        level, is_leaf = both[at], at < n
    kinds.append(is_leaf)
    take = 2 * n - 2
    lengths = np.zeros(n, np.int64)
    for is_leaf in reversed(kinds):
        leaves = int(is_leaf[:take].sum())
        lengths[:leaves] += 1
        take = 2 * (take - leaves)
    out[order] = lengths
    return out


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Code word of each symbol: ascending by (length, symbol)."""
    out = np.zeros(len(lengths), np.uint64)
    order = np.flatnonzero(lengths)
    order = order[np.argsort(lengths[order], kind="stable")]
    if len(order):
        # each code is the sum of the intervals before it, at its own length
        steps = np.left_shift(np.uint64(1), (MAX_BITS - lengths[order]).astype(np.uint64))
        first = np.cumsum(steps) - steps
        out[order] = np.right_shift(first, (MAX_BITS - lengths[order]).astype(np.uint64))
    return out


class Code:
    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        self.codes = canonical_codes(lengths)
        order = np.flatnonzero(lengths)
        order = order[np.argsort(lengths[order], kind="stable")]
        run = np.left_shift(1, MAX_BITS - self.lengths[order])
        table = np.zeros(1 << MAX_BITS, np.uint32)      # symbol * 32 + length
        table[:int(run.sum())] = np.repeat((order * 32 + self.lengths[order]).astype(np.uint32), run)
        self.table = table

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """(bits, bit offset of every STRIDE-th symbol)."""
        if not len(ids):
            return b"", np.zeros(0, np.int64)
        n = self.lengths[ids]
        end = np.cumsum(n)
        start = end - n
        # each code lies in one or two words of 32 bits, most significant bit first
        word, shift = start >> 5, 64 - (start & 31) - n
        value = np.left_shift(self.codes[ids], shift.astype(np.uint64))
        words = np.zeros(int(end[-1] >> 5) + 2, np.uint32)
        at = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        joined = np.bitwise_or.reduceat(value, at)
        words[word[at]] |= np.right_shift(joined, np.uint64(32)).astype(np.uint32)
        words[word[at] + 1] |= joined.astype(np.uint32)
        return words.astype(">u4").tobytes(), start[::STRIDE]

    def decode(self, bits: bytes, marks: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` symbols of a block: all checkpoints are followed in step."""
        if not n:
            return np.zeros(0, np.uint32)
        words = np.frombuffer(bits, ">u4").astype(np.uint64)
        words = np.concatenate([words, np.zeros(2, np.uint64)])
        pairs = (words[:-1] << np.uint64(32)) | words[1:]
        at = marks.astype(np.int64).copy()
        out = np.zeros((STRIDE, len(marks)), np.uint32)
        last = n - (len(marks) - 1) * STRIDE
        mask = np.uint64((1 << MAX_BITS) - 1)
        for k in range(STRIDE):
            live = at if k < last else at[:-1]
            if not len(live):
                break
            see = (pairs[live >> 5] >> (64 - MAX_BITS - (live & 31)).astype(np.uint64)) & mask
            hit = self.table[see]
            out[k, :len(live)] = hit >> 5
            live += hit & 31
        return out.T.reshape(-1)[:n]


@functools.lru_cache(maxsize=2)
def _code(lengths: bytes) -> Code:
    return Code(np.frombuffer(zlib.decompress(lengths), np.uint8))


def _bounds(docs: DataFrame, id_col: str, text_col: str) -> list[int]:
    """Ids that divide the documents into parts of about PART_CHARS characters.

    An id that holds more than a part's share stands there several times; its rows are dealt over those parts.
    """
    chars = docs.agg(F.sum(F.length(text_col))).first()[0] or 0
    parts = max(1, round(chars / PART_CHARS))
    if parts == 1:
        return []
    at = [i / parts for i in range(1, parts)]
    found = docs.agg(F.percentile_approx(F.col(id_col).cast("bigint"), at, 100_000)).first()[0]
    return [int(x) for x in found or []]


def sorted_ids(docs: DataFrame, path: str, keeps_space: bool, end_id: int, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Runs of encoded documents dealt to their file part: rows of about RUN_TOKENS from one input batch and part.

    A row has the part, and per document of the run: id, null flag, length,
    and all ids compressed.
    """
    prepare(docs.sparkSession)
    bounds = np.array(_bounds(docs, id_col, text_col), np.int64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tok = chunked(path, keeps_space, named=True)
        end = np.array([end_id], tok.dtype).tobytes()
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            texts = [t if isinstance(t, str) else "" for t in b["text"]]
            gone, keys = b["gone"].to_numpy(), b["doc_id"].to_numpy()
            lo, hi = np.searchsorted(bounds, keys, "left"), np.searchsorted(bounds, keys, "right")
            part = lo + (b["tie"].to_numpy() % (hi - lo + 1))
            part[gone] = 0
            ids = [x + end for p in blocks_of(list(map(len, texts))) for x in tok.encode(texts[p])]
            size = np.fromiter((len(x) // tok.dtype.itemsize for x in ids), np.int64, len(ids))
            rows = []
            for p in np.unique(part):
                whole = np.flatnonzero(part == p)
                for some in blocks_of(size[whole].tolist(), RUN_TOKENS):
                    at = whole[some]
                    raw = np.frombuffer(b"".join([ids[i] for i in at]), np.uint8).reshape(-1, tok.dtype.itemsize)
                    rows.append((int(p), keys[at].tobytes(), gone[at].tobytes(), size[at].tobytes(),
                                 squeeze(raw.T.tobytes()), tok.dtype.str))
            yield pd.DataFrame(rows, columns=["part", "docs", "gone", "sizes", "ids", "dtype"])

    key = F.col(id_col).cast("bigint")
    rows = docs.select(F.coalesce(key, F.lit(0)).alias("doc_id"), key.isNull().alias("gone"), F.col(text_col).alias("text"),
                       F.abs(F.hash(text_col, F.monotonically_increasing_id()) % 1009).cast("bigint").alias("tie"))
    runs = rows.mapInPandas(run, "part int, docs binary, gone binary, sizes binary, ids binary, dtype string")
    return stored(runs.repartition(len(bounds) + 1, "part"), "token-runs")


def _ids_of(row) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(row.ids), np.uint8)
    w = np.dtype(row.dtype).itemsize
    return np.ascontiguousarray(raw.reshape(w, -1).T).view(row.dtype).ravel() if len(raw) else np.zeros(0, row.dtype)


def count_ids(runs: DataFrame, vocabulary: int) -> np.ndarray:
    """How often each id occurs in all documents; the table is as long as the vocabulary."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(vocabulary, np.int64)
        for b in batches:
            for row in b.itertuples(index=False):
                total += np.bincount(_ids_of(row), minlength=vocabulary)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"id": at.astype(np.int32), "n": total[at]})

    counts = runs.select("ids", "dtype").mapInPandas(run, "id int, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    out = np.zeros(vocabulary, np.int64)
    for i, n in counts.collect():                     # at most one row for each id of the vocabulary
        out[i] = n
    return out


BLOCKS = ("part int, block int, n_docs int, n_tokens bigint, docs binary, gone binary, sizes binary, "
          "bits binary, marks binary, before bigint")


def write_files(docs: DataFrame, path: str, out: str, keeps_space: bool, end_id: int, vocabulary: int,
                id_col: str = "doc_id", text_col: str = "text") -> str:
    """Encode every document and write the token files below ``out``: blocks/ and code/.

    Null texts count as empty and hold the end id alone.  Documents stand in
    ascending order of id, those without an id first; of repeated ids all are
    written, in any order among themselves.  An empty table writes no blocks.
    Other columns are not read.
    """
    runs = sorted_ids(docs, path, keeps_space, end_id, id_col, text_col)
    lengths = code_lengths(count_ids(runs, vocabulary))
    packed = zlib.compress(lengths.tobytes())
    spark = docs.sparkSession
    spark.createDataFrame([(bytearray(packed),)], "lengths binary").coalesce(1).write.parquet(f"{out}/code")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        code = _code(packed)
        rows = list(pdf.itertuples(index=False))
        docs = np.concatenate([np.frombuffer(r.docs, np.int64) for r in rows])
        gone = np.concatenate([np.frombuffer(r.gone, bool) for r in rows])
        sizes = np.concatenate([np.frombuffer(r.sizes, np.int64) for r in rows])
        ids = np.concatenate([_ids_of(r) for r in rows])
        order = np.lexsort((docs, ~gone))
        starts = np.cumsum(sizes) - sizes
        made, before = [], 0
        for k, s in enumerate(blocks_of(sizes[order].tolist(), BLOCK_TOKENS)):
            at = order[s]
            block = np.concatenate([ids[starts[i]:starts[i] + sizes[i]] for i in at])
            bits, marks = code.encode(block)
            made.append((int(rows[0].part), k, len(at), len(block), docs[at].tobytes(), gone[at].tobytes(),
                         sizes[at].tobytes(), bits, marks.astype("<u4").tobytes(), before))
            before += len(block)
        return pd.DataFrame(made, columns=[c.split()[0] for c in BLOCKS.split(", ")])

    # a group is one part, of bounded size by its making
    (runs.groupBy("part").applyInPandas(run, BLOCKS).write.option("compression", "none").parquet(f"{out}/blocks"))
    return out


def read_files(spark: SparkSession, out: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files below ``out``, decoded from them."""
    return _read(spark, out, False)


def read_ids(spark: SparkSession, out: str) -> DataFrame:
    """(doc_id, start, ids array<int>) of every document in the files below ``out``."""
    return _read(spark, out, True)


def _read(spark: SparkSession, out: str, with_ids: bool) -> DataFrame:
    prepare(spark)
    packed = bytes(spark.read.parquet(f"{out}/code").first()[0])
    blocks = spark.read.schema(BLOCKS).parquet(f"{out}/blocks")
    # what stands before a part: one short row per part is scanned
    totals = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    ahead = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("ahead"))
    placed = blocks.join(ahead, "part").select("docs", "gone", "sizes", "n_tokens", "bits", "marks",
                                               (F.col("ahead") + F.col("before")).alias("at"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code = _code(packed)
        for b in batches:
            for r in b.itertuples(index=False):
                ids = code.decode(r.bits, np.frombuffer(r.marks, "<u4"), r.n_tokens).astype("<u4")
                sizes = np.frombuffer(r.sizes, np.int64)
                at = np.cumsum(sizes) - sizes
                docs = pd.array(np.frombuffer(r.docs, np.int64), "Int64")
                docs[np.frombuffer(r.gone, bool)] = pd.NA
                out = {"doc_id": docs, "start": at + r.at}
                each = [ids[i:i + n] for i, n in zip(at, sizes)]
                if with_ids:
                    out["ids"] = [x.astype(np.int32) for x in each]
                else:
                    out |= {"n_tokens": sizes, "ids_crc32": np.array([zlib.crc32(x.tobytes()) for x in each], np.int64)}
                yield pd.DataFrame(out)

    return placed.mapInPandas(run, "doc_id bigint, start bigint, " + (
        "ids array<int>" if with_ids else "n_tokens bigint, ids_crc32 bigint"))


def new_folder(spark: SparkSession) -> str:
    """A fresh folder for token files in the shared folder."""
    return scratch_path(spark, "token-files")

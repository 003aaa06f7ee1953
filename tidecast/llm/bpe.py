"""Byte-level BPE encoding and decoding over padded matrices (operator 4).

Distinct pieces are bucketed by length into padded numpy matrices of token
ids.  In each round every row merges its leftmost pair of minimum rank: ranks
come from a hashed pair table, and the row is compacted by one column.  Rows
without a mergeable pair leave the matrix.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import re
import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import blocks_of, prepare

NONE = np.int32(2**31 - 1)
#: Letters and digits that Unicode has assigned after version 16.
#: The rank files' own library still takes them for symbols, so the pattern must too.
LATER = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F),
    (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2),
    (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7),
    (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1),
    (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3),
    (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2),
    (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6),
    (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE),
    (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF),
    (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
)
_LATER = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in LATER) + "]")
#: Longer pieces are merged with a heap instead of a matrix row, which would cost the square of the length.
MATRIX_BYTES = 256
#: Entries and characters of a Python worker's piece cache; it is emptied when full.
CACHE, CACHE_CHARS = 400_000, 16_000_000
#: Cells of one padded matrix.
CELLS = 1 << 19


class PairTable:
    """Open-addressing table (left id, right id) -> rank of the joined bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        left, right, value = [], [], []
        for tok, r in ranks.items():
            for i in range(1, len(tok)):
                a = ranks.get(tok[:i])
                if a is None:
                    continue
                b = ranks.get(tok[i:])
                if b is not None:
                    left.append(a)
                    right.append(b)
                    value.append(r)
        keys = (np.array(left, np.int64) << 32) | np.array(right, np.int64)
        vals = np.array(value, np.int32)
        bits = max(4, int(len(keys) * 3).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.vals = np.full(1 << bits, NONE, np.int32)
        todo, at = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self.keys[at] == -1
            self.keys[at[free]] = keys[todo[free]]          # of several for one slot the last stays
            placed = self.keys[at] == keys[todo]
            self.vals[at[placed]] = vals[todo[placed]]
            todo, at = todo[~placed], (at[~placed] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where it does not merge (ids below 0 never do)."""
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        out = np.full(keys.shape, NONE, np.int32)
        flat, res = keys.ravel(), out.ravel()
        todo = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        at = self._slot(flat[todo])
        while len(todo):
            found = self.keys[at]
            hit = found == flat[todo]
            res[todo[hit]] = self.vals[at[hit]]
            go = ~hit & (found != -1)
            todo, at = todo[go], (at[go] + 1) & self.mask
        return out


class ByteBPE:
    """Encoder and decoder for one rank file, as tiktoken's ``encode_ordinary`` would answer."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.token = {i: t for t, i in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        self.pairs = PairTable(self.ranks)
        self.byte_id = np.array([self.ranks.get(bytes([i]), -1) for i in range(256)], np.int32)
        self.cache: dict[str, tuple[bytes, str]] = {}
        self.held = 0                                      # characters in the cache

    def merge(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each piece."""
        out: list = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            if p in self.ranks:
                out[i] = [self.ranks[p]]
            elif len(p) > MATRIX_BYTES:
                out[i] = self._long(p)
            else:
                buckets.setdefault(max(4, 1 << (len(p) - 1).bit_length()), []).append(i)
        for width, rows in buckets.items():
            step = max(1, CELLS // width)
            for lo in range(0, len(rows), step):
                part = rows[lo:lo + step]
                for i, ids in zip(part, self._matrix([pieces[i] for i in part], width)):
                    out[i] = ids
        return out

    def _matrix(self, pieces: list[bytes], width: int) -> list[list[int]]:
        n = len(pieces)
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(n, width)
        size = np.fromiter(map(len, pieces), np.int64, n)
        ids = np.where(np.arange(width) < size[:, None], self.byte_id[raw], np.int32(-1))
        rank = self.pairs.rank(ids[:, :-1], ids[:, 1:])
        rows, out = np.arange(n), [None] * n
        while len(rows):
            at = rank.argmin(axis=1)                       # the first of equal ranks: leftmost
            best = rank[np.arange(len(rows)), at]
            done = best == NONE
            if done.any():
                for r, line, k in zip(rows[done], ids[done], size[done]):
                    out[r] = line[:k].tolist()
                keep = ~done
                rows, ids, rank, size, at, best = rows[keep], ids[keep], rank[keep], size[keep], at[keep], best[keep]
                if not len(rows):
                    break
            k = np.arange(len(rows))
            ids[k, at] = best
            # compaction: what stands right of the merged pair moves one column left
            w = ids.shape[1]
            right = np.arange(1, w) > at[:, None]
            ids = np.concatenate([np.where(right[:, :w - 1], ids[:, 1:], ids[:, :-1]),
                                  np.full((len(rows), 1), -1, np.int32)], axis=1)
            ids[k, at] = best
            size -= 1
            if w > 2:
                r2 = np.arange(w - 1) >= (at + 1)[:, None]
                moved = np.concatenate([rank[:, 1:], np.full((len(rows), 1), NONE, np.int32)], axis=1)
                rank = np.where(r2, moved, rank)
            rank[k, at] = self.pairs.rank(ids[k, at], ids[k, np.minimum(at + 1, w - 1)])
            rank[k[at == w - 1], at[at == w - 1]] = NONE
            before = at > 0
            rank[k[before], at[before] - 1] = self.pairs.rank(ids[k[before], at[before] - 1], ids[k[before], at[before]])
            top = int(size.max())
            if top < w:                                    # drop the column that no row uses
                ids, rank = ids[:, :max(top, 2)], rank[:, :max(top, 2) - 1]
        return out

    def _long(self, piece: bytes) -> list[int]:
        """The same merges for one long piece: a heap of (rank, position) over a linked list."""
        ids = [self.ranks[bytes([b])] for b in piece]
        n = len(ids)
        parts = [piece[i:i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        get = self.ranks.get
        heap = [(r, i) for i in range(n - 1) if (r := get(parts[i] + parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j >= n or get(parts[i] + parts[j]) != r:
                continue
            parts[i] += parts[j]
            ids[i], parts[j] = r, None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (q := get(parts[i] + parts[k])) is not None:
                    heapq.heappush(heap, (q, i))
            if (h := before[i]) >= 0 and (q := get(parts[h] + parts[i])) is not None:
                heapq.heappush(heap, (q, h))
        return [x for x, p in zip(ids, parts) if p is not None]

    def learn(self, pieces: set[str]) -> None:
        """Put pieces into the cache: little-endian ids, and their decimal form."""
        new = [p for p in pieces if p not in self.cache]
        if len(self.cache) + len(new) > CACHE or self.held > CACHE_CHARS:
            self.cache.clear()
            new, self.held = list(pieces), 0
        self.held += sum(map(len, new))
        for p, ids in zip(new, self.merge([p.encode("utf-8", "surrogatepass") for p in new])):
            self.cache[p] = (np.array(ids, "<u4").tobytes(), ",".join(map(str, ids)))

    def split(self, text: str) -> list[str]:
        """The pattern's matches."""
        if text.isascii() or not _LATER.search(text):
            return self.pattern.findall(text)
        seen = _LATER.sub("\ue000", text)               # a symbol in every version, one for one
        return [text[m.start():m.end()] for m in self.pattern.finditer(seen)]

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, str]]:
        """(ids as uint32, decimal ids joined by commas) of each text."""
        split = [self.split(t) for t in texts]
        self.learn(set().union(*split))
        out = []
        for pieces in split:
            hits = [self.cache[p] for p in pieces]
            out.append((np.frombuffer(b"".join([h[0] for h in hits]), "<u4"), ",".join([h[1] for h in hits])))
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.token.__getitem__, ids.tolist()))


@functools.lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> ByteBPE:
    """One encoder for a Python worker."""
    return ByteBPE(path, pattern)


def _texts(s: pd.Series) -> list[str]:
    return [t if isinstance(t, str) else "" for t in s]


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every row's whole text; null counts as empty and gives no ids.

    Each match of ``pattern`` is encoded by itself; special tokens are not
    recognised.  Repeated rows are encoded alike, an empty table gives no
    rows, other columns are not read.
    """
    prepare(docs.sparkSession)

    @F.pandas_udf("array<int>")
    def run(s: pd.Series) -> pd.Series:
        bpe, texts = encoder(path, pattern), _texts(s)
        return pd.Series([x.astype(np.int32) for part in blocks_of(list(map(len, texts)))
                          for x, _ in bpe.encode(texts[part])], dtype=object)

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), run(text_col).alias("ids"))


def decode(tokens: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, decoded binary): the bytes that each row's ids stand for; null ids count as none."""
    prepare(tokens.sparkSession)

    @F.pandas_udf("binary")
    def run(s: pd.Series) -> pd.Series:
        bpe = encoder(path, pattern)
        return pd.Series([bpe.decode(np.asarray(x)) if x is not None else b"" for x in s], dtype=object)

    return tokens.select(F.col(id_col).cast("bigint").alias("doc_id"), run(ids_col).alias("decoded"))


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode, decode the ids, digest both in one pass.

    Rows, nulls and repeated rows as in ``encode``.
    """
    prepare(docs.sparkSession)

    @F.pandas_udf("n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    def run(s: pd.Series) -> pd.DataFrame:
        bpe, texts, out = encoder(path, pattern), _texts(s), []
        for part in blocks_of(list(map(len, texts))):
            for ids, text in bpe.encode(texts[part]):
                out.append((len(ids), hashlib.sha256(text.encode()).hexdigest(),
                            hashlib.sha256(bpe.decode(ids)).hexdigest()))
        return pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), run(text_col).alias("r")).select("doc_id", "r.*")

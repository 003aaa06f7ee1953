"""Best-fit packing of token pieces by swap-based local search (operator 6).

Pieces shorter than a sequence are dealt evenly over shards of bounded size.
Each shard places its pieces best-fit; a local search then exchanges pieces
between underfull bins, one for one or two for one, or moves them, always so
that the sum of squared fills grows, until bins run empty.
"""

from __future__ import annotations

import bisect
import zlib
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import blocks_of, columns_of, fresh, prepare, stored
from tidecast.llm.tokens import chunked

#: Pieces that one task packs together, about.
SHARD_PIECES = 10_000


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins (lists of item numbers): longest first, each into the fullest bin that has room."""
    bins: list[list[int]] = []
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]   # bins by free room
    rooms: list[int] = []                                          # the rooms that some bin has, ascending
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        k = bisect.bisect_left(rooms, n)
        if k == len(rooms):
            b, room = len(bins), capacity
            bins.append([])
        else:
            room = rooms[k]
            b = open_at[room].pop()
            if not open_at[room]:
                rooms.pop(k)
        bins[b].append(i)
        left = room - n
        if left:
            if not open_at[left]:
                bisect.insort(rooms, left)
            open_at[left].append(b)
    return bins


def fewest(lengths: np.ndarray, capacity: int) -> int:
    """A number of bins that no packing goes below: by the sum, and by the items of which a bin holds m at most."""
    least = -(-int(lengths.sum()) // capacity)
    for m in range(1, 9):
        least = max(least, -(-int((lengths > capacity // (m + 1)).sum()) // m))
    return least


def local_search(bins: list[list[int]], lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Exchange or move items between underfull bins while the squared fill grows; empty bins go.

    The emptiest underfull bin gives its fill away to bins at least as full:
    it moves an item, exchanges one for a smaller one, one for two, or two for
    one.  Every step raises the sum of squared fills, so the search ends: when
    every underfull bin was tried since the last one ran empty, or when no
    packing can have fewer bins.  Bins that hold items of the same sizes are
    tried once.
    """
    size = lengths.tolist()
    fill = [sum(size[i] for i in b) for b in bins]
    least, used = fewest(lengths, capacity), len(bins)
    weak = sorted((b for b in range(len(bins)) if fill[b] < capacity), key=lambda b: (fill[b], b))
    room = sum(capacity - fill[b] for b in weak)
    tried: set[tuple[int, ...]] = set()
    down = True
    while weak and used > least:
        a = next((b for b in weak if tuple(sorted(size[i] for i in bins[b])) not in tried), None)
        if a is None or room - (capacity - fill[a]) < fill[a]:
            break
        tried.add(tuple(sorted(size[i] for i in bins[a])))
        alike: set[tuple[int, ...]] = set()
        for b in [b for b in (reversed(weak) if down else weak) if b != a]:
            kind = tuple(sorted(size[j] for j in bins[b]))
            if kind in alike:                               # no step with a bin of these sizes
                continue
            changed = False
            while fill[a] and capacity > fill[b] >= fill[a]:
                step = _best_step(bins[a], bins[b], size, capacity - fill[b])
                if step is None:
                    break
                changed = True
                give, take = step
                for i in give:
                    bins[a].remove(i)
                for j in take:
                    bins[b].remove(j)
                bins[a] += take
                bins[b] += give
                gain = sum(size[i] for i in give) - sum(size[j] for j in take)
                fill[a] -= gain
                fill[b] += gain
            if not fill[a]:
                break
            if changed:
                alike.clear()
            elif fill[b] >= fill[a]:
                alike.add(kind)
        if fill[a]:
            tried.add(tuple(sorted(size[i] for i in bins[a])))
            down = not down
        else:
            room -= capacity
            used -= 1
            tried.clear()
        weak = sorted((b for b in weak if 0 < fill[b] < capacity), key=lambda b: (fill[b], b))
    return [b for b in bins if b]


def _best_step(a: list[int], b: list[int], size: list[int], room: int):
    """The exchange that fills ``b`` by the most, at most ``room``: (items of a, items of b), or None."""
    best, found = 0, None
    ours = sorted((size[i], i) for i in a)
    theirs = sorted((size[j], j) for j in b)
    pairs = sorted((x + y, j, k) for n, (x, j) in enumerate(theirs) for y, k in theirs[n + 1:])
    for n, i in ours:
        if best < n <= room:                                # a move
            best, found = n, ([i], [])
        k = bisect.bisect_left(theirs, (n - room, -1))      # one for one
        if k < len(theirs) and best < n - theirs[k][0] <= room:
            best, found = n - theirs[k][0], ([i], [theirs[k][1]])
        k = bisect.bisect_left(pairs, (n - room, -1, -1))   # one of a for two of b
        if k < len(pairs) and best < n - pairs[k][0] <= room:
            best, found = n - pairs[k][0], ([i], [pairs[k][1], pairs[k][2]])
    if best < room:
        twos = sorted((x + y, i, j) for n, (x, i) in enumerate(ours) for y, j in ours[n + 1:])
        sums = [t[0] for t in twos]
        for n, j in theirs:                                 # two of a for one of b
            k = bisect.bisect_right(sums, n + room) - 1
            if k >= 0 and sums[k] - n > best:
                best, found = sums[k] - n, ([twos[k][1], twos[k][2]], [j])
    return found


def pack(pieces: DataFrame, capacity: int = 1024, shard_pieces: int = SHARD_PIECES, length_col: str = "length") -> DataFrame:
    """``pieces`` with sequence_id and offset: sequences of at most ``capacity`` tokens, gapless from 0.

    A piece of ``capacity`` tokens is a sequence of its own.  The others are
    dealt over shards by a hash of the row and its place, so that no key and
    no number of equal rows makes a shard large; a shard holds about
    ``shard_pieces`` pieces whatever the table's size.  Sequence numbers are
    any distinct numbers.  Pieces without a length, below 1 or over
    ``capacity`` are refused; an empty table gives no rows; columns named
    sequence_id or offset are replaced.  The pieces are materialised first.
    """
    prepare(pieces.sparkSession)
    pieces = pieces.drop("sequence_id", "offset")
    row, = fresh(pieces, "__row")
    rows = stored(pieces.withColumn(row, F.monotonically_increasing_id()), "pieces")
    n = F.col("`" + length_col.replace("`", "``") + "`")
    total, bad = rows.agg(F.count_if(n < capacity), F.count_if(n.isNull() | (n < 1) | (n > capacity))).first()
    if bad:
        raise ValueError(f"{bad} pieces have no length between 1 and {capacity}")
    shards = max(1, round(total / shard_pieces))
    # numbers and lengths alone go to Python; the pieces' own columns join by the number
    dealt = rows.where(n < capacity).select(F.col(row).alias("row"), n.cast("int").alias("length")) \
        .withColumn("tie", F.xxhash64("row")).withColumn("shard", F.pmod("tie", F.lit(shards)).cast("int"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "tie", "row"], kind="stable")
        lengths = pdf["length"].to_numpy().astype(np.int64)
        bins = local_search(best_fit(lengths, capacity), lengths, capacity)
        counts = np.fromiter(map(len, bins), np.int64, len(bins))
        order = np.fromiter((i for b in bins for i in b), np.int64, int(counts.sum()))
        size = lengths[order]
        before = np.cumsum(size) - size
        at = np.cumsum(counts) - counts
        return pd.DataFrame({"row": pdf["row"].to_numpy()[order],
                             "sequence_id": np.repeat(np.arange(len(bins)), counts) * shards + int(pdf["shard"].iloc[0]),
                             "offset": before - np.repeat(before[at], counts)})

    placed = dealt.groupBy("shard").applyInPandas(run, "row bigint, sequence_id bigint, offset bigint") \
        .withColumnRenamed("row", row)
    whole = (rows.where(n == capacity).withColumn("sequence_id", -1 - F.col(row))
             .withColumn("offset", F.lit(0).cast("bigint")))
    cols = [*columns_of(pieces), F.col("sequence_id"), F.col("offset")]
    return rows.where(n < capacity).join(placed, row).select(*cols).unionByName(whole.select(*cols))


def token_pieces(docs: DataFrame, path: str, end_id: int, capacity: int = 1024, with_ids: bool = False,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, and on request the ids themselves.

    A document is its text's ids and ``end_id``; null counts as empty.  Only
    documents over ``capacity`` are cut, into pieces of ``capacity`` tokens of
    which the first may be shorter.  Repeated rows and null ids are documents
    of their own; an empty table gives no rows; other columns are not read.
    """
    prepare(docs.sparkSession)
    fields = "piece array<int>, start array<bigint>, length array<bigint>, ids_crc32 array<bigint>" \
        + ", ids array<array<int>>" * with_ids

    @F.pandas_udf(fields)
    def run(s: pd.Series) -> pd.DataFrame:
        tok = chunked(path, True, named=True)
        end = np.array([end_id], tok.dtype).tobytes()
        texts, out = [t if isinstance(t, str) else "" for t in s], []
        for part in blocks_of(list(map(len, texts))):
            for raw in tok.encode(texts[part]):
                ids = np.frombuffer(raw + end, tok.dtype).astype("<u4")
                cuts = [*range(len(ids) % capacity or capacity, len(ids), capacity)] if len(ids) > capacity else []
                lo, hi = [0, *cuts], [*cuts, len(ids)]
                out.append((list(range(len(lo))), lo, [z - a for a, z in zip(lo, hi)],
                            [zlib.crc32(ids[a:z].tobytes()) for a, z in zip(lo, hi)],
                            [ids[a:z].astype(np.int32) for a, z in zip(lo, hi)])[:4 + with_ids])
        return pd.DataFrame(out, columns=["piece", "start", "length", "ids_crc32", "ids"][:4 + with_ids], dtype=object)

    names = ["piece", "start", "length", "ids_crc32", "ids"][:4 + with_ids]
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), run(text_col).alias("p")).select(
        "doc_id", F.inline(F.arrays_zip(*[F.col(f"p.{c}").alias(c) for c in names])))


def sequences(packed: DataFrame, capacity: int = 1024) -> DataFrame:
    """(sequence_id, ids): the token ids of every sequence, from packed pieces that carry ``ids``.

    A group is one sequence, so at most ``capacity`` ids.  An empty table
    gives no rows; columns other than sequence_id, offset and ids are not read.
    """
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])).alias("ids"))

"""Removal of byte strings that occur more than once, by column-wise construction (operator 3).

Whether the 400 bytes at a place occur anywhere else is read off neighbouring
suffixes: in sorted order a repeated string shares 400 bytes with the suffix
before or after it.  The order is built column by column over many strings at
once: every round inserts one symbol of each string before its suffixes seen
so far, which moves the suffixes (the rows of the collection's Burrows-Wheeler
transform) by a stable sort on that symbol, and updates the common prefixes of
neighbours.  Columns stream from an external file, last one first.

To deal the work over tasks, every window of 400 bytes is assigned to the
smallest hashed k-gram inside it, its anchor; equal windows have equal
anchors at the same distance.  The windows of one anchor occurrence form a
short segment, and the segments of equal anchors are one aligned collection.
Anchors and segments that occur once are left out: nothing in them can repeat.
Equal segments are folded into one with a count before they are sorted.  A
collection with too many different segments for one task is cut into narrower
ranges of windows, whose common core separates it further, down to single
windows, which fold completely.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import blocks_of, columns_of, fresh, prepare, ragged_ranges, stored, utf8

#: Bytes of the string that must occur elsewhere.
LENGTH = 400
#: Bytes of an anchor's k-gram.
GRAM = 32
#: Different segments of one collection that a task sorts together; larger collections are cut.
HOT = 4096
#: Segments whose columns one task holds in its external file at once.
TASK_SEGMENTS = 8192
#: Widths of the window ranges into which a hot collection is cut, level by level.
WIDTHS = (48, 8, 1)

_TABLE = np.frombuffer(b"".join(hashlib.sha256(b"byte %d" % i).digest()[:8] for i in range(256)), "<u8")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(text: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Hash of the ``gram`` bytes at each place (a power of two), by doubling."""
    h, size, mult = _TABLE[text], 1, _MIX
    while size < gram:
        h = h[:-size] * mult + h[size:]
        mult = np.uint64(int(mult) * int(mult) % 2**64 | 1)
        size *= 2
    h ^= h >> np.uint64(29)
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def sliding_argmin(key: np.ndarray, width: int) -> np.ndarray:
    """Smallest key of the ``width`` keys from each place on."""
    m, size = key, 1
    while size * 2 <= width:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    return np.minimum(m[:len(key) - width + 1], m[width - size:])


def anchors(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text number, place of the anchor, its hash, first and last window assigned to it) of every anchor.

    Ties between equal hashes go to the leftmost, which the window's content fixes too.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    empty = tuple(np.zeros(0, np.int64) for _ in range(5))
    if not len(texts) or sizes.max() < length:
        return empty
    flat = np.frombuffer(b"".join(texts), np.uint8)
    starts = np.cumsum(sizes) - sizes
    h = gram_hashes(flat, gram)
    place = np.uint64(31)                                     # low bits of a key; the others are the hash's
    key = ((h >> place) << place) | np.arange(len(h), dtype=np.uint64)
    low = sliding_argmin(key, length - gram + 1)
    at = (low & ((np.uint64(1) << place) - np.uint64(1))).astype(np.int64)
    fits = sizes >= length
    windows = ragged_ranges(starts[fits], sizes[fits] - length + 1)
    owner = np.repeat(np.flatnonzero(fits), sizes[fits] - length + 1)
    a = at[windows]
    new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (owner[1:] != owner[:-1])]))
    last = np.concatenate([new[1:], [len(a)]]) - 1
    who = owner[new]
    base = starts[who]
    return who, a[new] - base, h[a[new]].view(np.int64), windows[new] - base, windows[last] - base


def columns(segments: list[bytes], left: np.ndarray, group: np.ndarray, count: np.ndarray,
            length: int = LENGTH, folder: str | None = None) -> list[list[tuple[int, int]]]:
    """Runs (first, last) of repeated windows of each segment, in columns.

    Segment i covers the columns from left[i] on; ``group`` is ascending, and
    only segments of one group are compared.  A segment that stands for
    several occurrences (count over 1) repeats in all its windows.
    """
    m = len(segments)
    size = np.fromiter(map(len, segments), np.int64, m)
    lo, hi = int(left.min()), int((left + size).max())
    fd, name = tempfile.mkstemp(dir=folder)
    try:
        with os.fdopen(fd, "wb") as f:                       # the file: one column after the other
            block = 256
            flat = np.frombuffer(b"".join(segments), np.uint8)
            at = np.cumsum(size) - size
            for c0 in range(lo, hi, block):
                cols = np.arange(c0, min(hi, c0 + block))
                inside = (cols[:, None] >= left) & (cols[:, None] < left + size)
                place = np.where(inside, cols[:, None] - left + at, 0)
                f.write(np.where(inside, flat[place].astype(np.int16) + 1, 0).astype("<i2").tobytes())
        order = np.arange(m)                                  # suffixes in sorted order, group by group
        same_group = np.concatenate([[False], group[1:] == group[:-1]])
        common = np.zeros(m, np.int64)                        # bytes shared with the suffix before, in order
        rank_group = group.astype(np.int64)
        many = count > 1
        last_window = left + size - length
        was = np.zeros(m, bool)
        events = []
        with open(name, "rb") as f:
            for c in range(hi - 1, lo - 1, -1):
                f.seek((c - lo) * m * 2)
                symbol = np.frombuffer(f.read(m * 2), "<i2")[order]
                key = rank_group * 512 + symbol
                if (key[1:] < key[:-1]).any():
                    move = np.argsort(key, kind="stable")
                    shared = same_group.copy()
                    shared[1:] &= symbol[move[1:]] == symbol[move[:-1]]
                    new = np.zeros(m, np.int64)
                    near = np.concatenate([[False], move[1:] == move[:-1] + 1])
                    k = np.flatnonzero(shared & near)
                    new[k] = common[move[k]] + 1
                    k = np.flatnonzero(shared & ~near)
                    if len(k):                                # the smallest common prefix between the two old places
                        ends = np.stack([move[k - 1] + 1, move[k] + 1], axis=1).ravel()
                        padded = np.append(common, 0)
                        new[k] = np.minimum.reduceat(padded, ends)[::2] + 1
                    order, symbol, common = order[move], symbol[move], new
                else:
                    shared = same_group.copy()
                    shared[1:] &= symbol[1:] == symbol[:-1]
                    common = np.where(shared, common + 1, 0)
                common[symbol == 0] = 0
                if c > lo + (hi - lo) - length:               # no suffix is long enough yet
                    continue
                long = common >= length
                hit = long.copy()
                hit[:-1] |= long[1:]
                now = np.zeros(m, bool)
                now[order] = hit
                now |= many
                now &= (c >= left) & (c <= last_window)
                turn = np.flatnonzero(now != was)
                if len(turn):
                    events.append((turn, np.full(len(turn), c), now[turn]))
                was = now
    finally:
        os.unlink(name)
    open_at = {int(i): lo for i in np.flatnonzero(was)}
    runs: list[list[tuple[int, int]]] = [[] for _ in range(m)]
    ends: dict[int, int] = {}
    for turn, col, on in events:                              # columns descend: a run's last window comes first
        for i, c, o in zip(turn.tolist(), col.tolist(), on.tolist()):
            if o:
                ends[i] = c
            else:
                runs[i].append((c + 1, ends.pop(i)))
    for i in open_at:
        runs[i].append((lo, ends.pop(i)))
    return runs


def _sorted_runs(folded: DataFrame, length: int) -> DataFrame:
    """(home, a, b) of every folded segment with repeated windows: arrays of its runs in columns, by the column-wise sort."""

    def solve(parts: list[pd.DataFrame]) -> pd.DataFrame:
        p = pd.concat(parts, ignore_index=True).drop_duplicates("home")      # cut from repeated rows
        grp = pd.factorize(p["grp"])[0].astype(np.int64)
        found = columns(p["bytes"].tolist(), p["lo"].to_numpy().astype(np.int64), grp, p["n"].to_numpy(), length)
        hit = [i for i, r in enumerate(found) if r]
        return pd.DataFrame({"home": pd.Series(p["home"].iloc[hit].tolist(), dtype=object),
                             "a": pd.Series([[x for x, _ in found[i]] for i in hit], dtype=object),
                             "b": pd.Series([[y for _, y in found[i]] for i in hit], dtype=object)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for b in batches:
            while len(b):
                if n < TASK_SEGMENTS:
                    take, b = b.iloc[:TASK_SEGMENTS - n], b.iloc[TASK_SEGMENTS - n:]
                    held.append(take)
                    n += len(take)
                    continue
                # full: what belongs to the last group goes on with the next round
                p = pd.concat(held, ignore_index=True)
                same = (p["grp"] == p["grp"].iloc[-1]).to_numpy()
                cut = int(np.argmax(same))
                if cut:
                    yield solve([p.iloc[:cut]])
                    held, n = [p.iloc[cut:]], len(p) - cut
                    continue
                more = (b["grp"] == p["grp"].iloc[-1]).to_numpy()   # one group alone, of at most HOT segments
                k = int(np.argmin(more)) if not more.all() else len(b)
                held, n, b = [p, b.iloc[:k]], n + k, b.iloc[k:]
                if len(b):
                    yield solve(held)
                    held, n = [], 0
        if n:
            yield solve(held)

    dealt = folded.select("home", "lo", "grp", "bytes", "n").repartition("grp").sortWithinPartitions("grp")
    return dealt.mapInPandas(run, "home binary, a array<int>, b array<int>")


def _narrow(folded: DataFrame, width: int, length: int) -> DataFrame:
    """Segments cut into ranges of ``width`` windows: one row for each segment and range, keyed by the range's core."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                last = r.lo + len(r.bytes) - length
                for first in range(r.lo // width * width, last + 1, width):
                    a, z = max(r.lo, first), min(last, first + width - 1)
                    part = r.bytes[a - r.lo:z - r.lo + length]
                    core = r.bytes[first + width - 1 - r.lo:first + length - r.lo]    # in all windows of the range
                    key = _digest(b"%d %d " % (r.grp, first) + core)
                    grp = int.from_bytes(key[:8], "little", signed=True)
                    out.append((r.home, _digest(key + b"%d " % a + part), a, grp, part, r.n))
            yield pd.DataFrame(out, columns=["parent", "home", "lo", "grp", "bytes", "n"])

    return folded.select("home", "lo", "grp", "bytes", "n").mapInPandas(
        run, "parent binary, home binary, lo int, grp bigint, bytes binary, n bigint")


def _digest(data: bytes) -> bytes:
    return hashlib.sha256(data).digest()[:16]


def _cut_hot(folded: DataFrame, length: int, hot: int, widths: tuple[int, ...]) -> DataFrame:
    """Runs of segments in hot groups: cut, folded and solved again, then joined back to their segments."""
    cut = stored(_narrow(folded.dropDuplicates(["home"]), widths[0], length), "segment-ranges")
    parts = stored(cut.groupBy("home").agg(F.first("lo").alias("lo"), F.first("grp").alias("grp"),
                                           F.first("bytes").alias("bytes"), F.sum("n").alias("n")), "segment-parts")
    groups = stored(parts.groupBy("grp").agg(F.count("*").alias("k"), F.sum("n").alias("total"))
                    .where("total > 1"), "segment-groups")
    last = len(widths) == 1                               # single windows: a group is one window's text
    some = groups if last else groups.where(F.col("k") <= hot)
    solved = _sorted_runs(parts.join(some.select("grp"), "grp", "left_semi"), length)
    if not last:
        big = groups.where(F.col("k") > hot).select("grp")
        if not big.isEmpty():
            solved = solved.unionByName(_cut_hot(parts.join(big, "grp", "left_semi"), length, hot, widths[1:]))
    return cut.select("parent", "home").join(solved, "home").select(F.col("parent").alias("home"), "a", "b")


def repeated_spans(docs: DataFrame, length: int = LENGTH, hot: int = HOT, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(doc_id, th, a, b): starts and ends of each text's byte ranges that strings of ``length`` bytes found elsewhere cover.

    ``th`` is a hash of the text, so that different texts under one id stay
    apart.  Ranges of a text may overlap; only texts with such ranges have a
    row.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")) \
        .where(F.octet_length("text") >= length).withColumn("th", F.xxhash64("text"))

    @F.pandas_udf("at array<int>, a array<int>, b array<int>, grp array<bigint>, home array<binary>")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            texts, made = utf8(s), []
            for part in blocks_of([len(t) for t in texts], 1 << 20):
                some = texts[part]
                who, at, h, first, last = anchors(some, length)
                home = [_digest(b"%d %d " % (g, a - p) + some[w][a:z + length])
                        for w, p, g, a, z in zip(who.tolist(), at.tolist(), h.tolist(), first.tolist(), last.tolist())]
                cuts = np.searchsorted(who, np.arange(len(some) + 1))
                cols = (at.astype(np.int32), first.astype(np.int32), last.astype(np.int32), h)
                made += [(*(c[i:j] for c in cols), home[i:j]) for i, j in zip(cuts, cuts[1:])]
            yield pd.DataFrame(made, columns=["at", "a", "b", "grp", "home"], dtype=object)

    found = rows.select("doc_id", "th", find("text").alias("f")).select(
        "doc_id", "th", F.inline(F.arrays_zip(*[F.col(f"f.{c}").alias(c) for c in ("at", "a", "b", "grp", "home")])))
    found = stored(found, "anchors")
    homes = stored(found.groupBy("home").agg(F.first("grp").alias("grp"), F.count("*").alias("n"),
                                             F.min(F.struct("doc_id", "th", "at", "a", "b")).alias("rep")), "segments")
    groups = stored(homes.groupBy("grp").agg(F.count("*").alias("k"), F.sum("n").alias("total"))
                    .where("total > 1"), "segment-groups")
    sized = homes.join(groups.select("grp", "k"), "grp")
    # a group with one segment text: its occurrences are equal, all their windows repeat
    lo = F.col("rep.a") - F.col("rep.at")
    runs = sized.where("k = 1").select("home", F.array(lo).alias("a"), F.array(F.col("rep.b") - F.col("rep.at")).alias("b"))
    # other groups are sorted: each different segment is cut once, from one of its occurrences
    several = sized.where("k > 1").select(
        F.col("rep.doc_id").alias("id"), F.col("rep.th").alias("key"), F.struct(
            "home", F.col("rep.a").alias("a"), F.col("rep.b").alias("b"), lo.alias("lo"), "grp", "n",
            (F.col("k") > hot).alias("hot")).alias("s"))
    wanted = several.groupBy("id", "key").agg(F.collect_list("s").alias("s"))

    @F.pandas_udf("array<binary>")
    def cut(text: pd.Series, a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([[t[i:j + length] for i, j in zip(x, y)] for t, x, y in zip(utf8(text), a, b)], dtype=object)

    pieces = rows.join(wanted, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("th"))).select(
        "s", cut("text", F.col("s.a"), F.col("s.b")).alias("bytes"))
    folded = pieces.select(F.explode(F.arrays_zip("s", "bytes")).alias("p")).select(
        "p.s.home", "p.s.lo", "p.s.grp", "p.bytes", "p.s.n", "p.s.hot")
    folded = stored(folded, "segment-texts")
    runs = runs.unionByName(_sorted_runs(folded.where("NOT hot"), length))
    if not folded.where("hot").isEmpty():
        runs = runs.unionByName(_cut_hot(folded.where("hot"), length, hot, WIDTHS))
    placed = found.select("doc_id", "th", "at", "home").join(runs, "home").select(
        "doc_id", "th", F.explode(F.arrays_zip("a", "b")).alias("r"), "at").select(
        "doc_id", "th", (F.col("r.a") + F.col("at")).alias("a"), (F.col("r.b") + F.col("at") + length).alias("b"))
    return placed.groupBy("doc_id", "th").agg(F.array_sort(F.collect_set(F.struct("a", "b"))).alias("s")).select(
        "doc_id", "th", F.col("s.a").alias("a"), F.col("s.b").alias("b"))


def merged(a, b) -> list[tuple[int, int]]:
    """Disjoint ascending ranges from ranges sorted by their start."""
    out: list[tuple[int, int]] = []
    for x, y in zip(a, b) if a is not None else ():
        if out and x <= out[-1][1]:
            out[-1] = (out[-1][0], max(int(y), out[-1][1]))
        else:
            out.append((int(x), int(y)))
    return out


def _with_spans(docs: DataFrame, length: int, id_col: str, text_col: str) -> tuple[DataFrame, str, str]:
    """Every row of ``docs`` with two more columns, starts and ends (null where nothing repeats), and their names."""
    i, th, a, b = fresh(docs, "__id", "__th", "__a", "__b")
    spans = repeated_spans(docs, length, id_col=id_col, text_col=text_col).select(
        F.col("doc_id").alias(i), F.col("th").alias(th), F.col("a").alias(a), F.col("b").alias(b))
    on = F.col(i).eqNullSafe(F.col(id_col).cast("bigint")) & (F.col(th) == F.xxhash64(F.col(text_col)))
    return docs.join(spans, on, "left").drop(i, th), a, b


def report(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row of ``docs``.

    Texts are UTF-8 bytes, a null one is empty; matches never cross documents.
    A byte is removed if a string of ``length`` bytes covers it that also
    starts anywhere else, in the same document or another; strings are judged
    on the input.  So of repeated rows all lose their common bytes.  An empty
    table gives no rows; other columns are not read.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))

    @F.pandas_udf("n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    def digest(text: pd.Series, a: pd.Series, b: pd.Series) -> pd.DataFrame:
        out = []
        for t, x, y in zip(utf8(text), a, b):
            cut, at, kept = merged(x, y), 0, hashlib.sha256()
            for lo, hi in cut:
                kept.update(t[at:lo])
                at = hi
            kept.update(t[at:])
            out.append((len(t), sum(hi - lo for lo, hi in cut), len(cut), kept.hexdigest()))
        return pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])

    found, a, b = _with_spans(rows, length, "doc_id", "text")
    return found.select("doc_id", digest("text", a, b).alias("d")).select("doc_id", "d.*")


def remove(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated bytes taken out of the text; all rows and other columns stay, whatever their names.

    What a removed range leaves of a character that it cuts is dropped with it.
    """
    prepare(docs.sparkSession)

    @F.pandas_udf("string")
    def keep(text: pd.Series, a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for t, x, y in zip(utf8(text), a, b):
            at, parts = 0, []
            for lo, hi in merged(x, y):
                parts.append(t[at:lo].decode("utf-8", "ignore"))
                at = hi
            out.append("".join([*parts, t[at:].decode("utf-8", "ignore")]))
        return pd.Series(out, dtype=object)

    found, a, b = _with_spans(docs, length, id_col, text_col)
    return found.withColumn(text_col, F.when(F.col(a).isNull(), F.col(text_col))
                            .otherwise(keep(text_col, a, b))).select(*columns_of(docs))

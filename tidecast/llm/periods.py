"""Periodic runs of words by an online sparse diagonal walk (operator 13).

A run of period q is a stretch whose words equal the words q places before.
Walking a text, a word's earlier occurrence j at position i lengthens the match
of the diagonal (lag) i - j; a lag that is not lengthened ends there and is a
run if its match was long enough.

Frequent words have too many earlier occurrences to walk, and a word repeated
n times has n^2 / 2.  Only occurrences that can lie on a run are walked: a run
of smallest period q in lo..hi holds at least 3 * q matches, every string of
2 * hi <= 3 * lo words in it has smallest period q, so the last earlier
occurrence of the string that ends at i stands exactly q places before.  So at
most one occurrence per position and band of lags counts, none is lost, and a
lag that is a multiple of a run's period never becomes active.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import blocks_of, prepare, ragged_ranges, utf8

LEAST, FACTOR = 6, 4


def bands(n: int, least: int = LEAST, factor: int = FACTOR) -> Iterator[tuple[int, int, int]]:
    """(smallest lag, largest lag, string length) of each band of lags that n words leave room for."""
    lo = 1
    while factor * lo <= n:
        # a run of lag q holds max(least - q, (factor - 1) * q) matches or more
        length = max(2, (factor - 1) * lo, least - lo)
        hi = max(lo, length // 2) if lo > 1 else 1
        yield lo, hi, length
        lo = hi + 1


def _mixed(ids: np.ndarray, seed: int) -> np.ndarray:
    x = (ids.astype(np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def earlier(ids: np.ndarray, first: np.ndarray, at: np.ndarray, length: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """For those places of ``at`` whose last ``length`` words occur before in the same text: (place, last such place).

    ``first`` is the start of each place's text.  Strings are compared by a
    hash; equal ones are checked word by word, and on a false match all are
    hashed anew.
    """
    at = at[at - first[at] >= length - 1]
    if len(at) < 2:
        return at[:0], at[:0]
    # sums of hashes times odd powers: a string's hash from two prefix sums
    base = 0x2545F4914F6CDD1D * (2 * seed + 1) & (2 ** 64 - 1)
    lo, hi = int(at[0]) - length + 1, int(at[-1]) + 1
    power = np.full(hi - lo + 1, base, np.uint64)
    power[0] = 1
    power = np.cumprod(power)
    total = np.zeros(hi - lo + 1, np.uint64)
    np.cumsum(_mixed(ids[lo:hi], seed) * power[:-1], out=total[1:])
    end = at + 1 - lo
    key = (total[end] - total[end - length]) * power[hi - lo - end]
    key ^= _mixed(first[at], 7)
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    here, before = at[order[1:][same]], at[order[:-1][same]]
    keep = np.argsort(here)
    here, before = here[keep], before[keep]
    # neighbouring places of one lag share all words but one: the first string of each stretch is compared whole
    new = np.ones(len(here), bool)
    new[1:] = (np.diff(here) != 1) | (np.diff(here - before) != 0)
    size = np.where(new, length, 1)
    step = max(1, (1 << 22) // length)
    for s in range(0, len(here), step):                       # at most 4 million words at once
        n = size[s:s + step]
        back = ragged_ranges(np.zeros(len(n), np.int64), n)
        x, y = np.repeat(here[s:s + step], n) - back, np.repeat(before[s:s + step], n) - back
        if (ids[x] != ids[y]).any() or (first[here] != first[before]).any():
            return earlier(ids, first, at, length, seed + 1)
    return here, before


def runs(ids: np.ndarray, lengths: np.ndarray, least: int = LEAST, factor: int = FACTOR) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of every run in each of the texts whose word ids stand in a row.

    Starts count from the first word of ``ids``; runs are in the order of their ends.
    """
    first = np.repeat(np.cumsum(lengths) - lengths, lengths)
    at = np.arange(len(ids))
    reach = np.zeros(len(ids), np.int64)                      # words up to here that have one of the periods found
    places, lags, known = [], [], []
    for lo, hi, length in bands(int(lengths.max()) if len(lengths) else 0, least, factor):
        # a string inside a run found already has a smaller period, and so has its like anywhere
        inside = reach[at] >= length
        here, before = earlier(ids, first, at[~inside], length)
        lag = here - before
        # a longer string repeats only where this one does, here or as the earlier one; those inside runs are not told
        again = np.zeros(len(ids), bool)
        again[here] = again[before] = again[at[inside]] = True
        at = np.flatnonzero(again)
        near = (lag >= lo) & (lag <= hi)
        here, lag = here[near], lag[near]
        places.append(here)
        lags.append(lag)
        known.append(np.full(len(here), length))
        if len(here):
            new = np.ones(len(here), bool)
            new[1:] = (np.diff(here) != 1) | (np.diff(lag) != 0)
            begin = here[np.maximum.accumulate(np.where(new, np.arange(len(here)), 0))]
            reach[here] = np.maximum(reach[here], length + lag + here - begin)
        if not len(at):
            break
    if not places:
        return []
    place, lag, length = map(np.concatenate, (places, lags, known))
    # the walk: a lag's first occurrence brings the string's words, each next one word
    out: list[tuple[int, int, int]] = []
    active: dict[tuple[int, int], list[int]] = {}
    order = np.lexsort((lag, place))
    place, lag, length = place[order], lag[order], length[order]
    text = first[place] if len(place) else place

    def end(q: int, last: int, matches: int) -> None:
        if matches + q >= max(least, factor * q):
            out.append((last - matches + 1 - q, matches + q, q))

    for i, q, n, t in zip(place.tolist(), lag.tolist(), length.tolist(), text.tolist()):
        state = active.get(q)
        if state is not None and state[0] == i - 1 and state[2] == t:
            state[0] = i
            state[1] += 1
            continue
        if state is not None:
            end(q, state[0], state[1])
        active[q] = [i, n, t]
    for q, (last, matches, _) in active.items():
        end(q, last, matches)
    return out


def planted(doc_id, n: int) -> np.ndarray:
    """Original word number of each word after the made repetition of one document in ten (null ids: none)."""
    at = np.arange(n)
    if doc_id is None or not n:
        return at
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return at
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at[a:] = a + (at[a:] - a) % p
    return at


def digest(found: list[tuple[int, int, int]], words: list[bytes]) -> tuple:
    """The contract's columns of one text from its runs and words."""
    found = sorted(found, key=lambda r: (r[0], r[2]))
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    best = (None,) * 4
    kept = words
    if found:
        # greatest length / period, compared as whole numbers crosswise
        top = found[0]
        for r in found[1:]:
            if r[1] * top[2] > top[1] * r[2]:
                top = r
        best = (*top, 1000 * top[1] // top[2])
        drop = np.zeros(len(words) + 1, np.int64)
        for s, n, q in found:
            drop[s + q] += 1
            drop[s + n] -= 1
        kept = [words[i] for i in np.flatnonzero(np.cumsum(drop[:-1]) == 0).tolist()]
    return (len(found), *best, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest())


SCHEMA = ("doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
          "runs_sha256 string, collapsed_sha256 string")


def _block(doc_ids: list, texts: list[bytes], plant: bool) -> Iterator[tuple[object, list[bytes], list[tuple[int, int, int]]]]:
    """(doc_id, words, runs) of each text of one block."""
    words = [t.split() for t in texts]                        # at the bytes 0x20 and 0x09 to 0x0D
    number = {w: k for k, w in enumerate(set(chain.from_iterable(words)))}
    ids = []
    for n, (i, w) in enumerate(zip(doc_ids, words)):
        k = np.fromiter(map(number.__getitem__, w), np.int64, len(w))
        if plant and len(w):
            at = planted(i, len(w))
            if at[-1] != len(w) - 1:
                k = k[at]
                words[n] = [w[j] for j in at.tolist()]
        ids.append(k)
    size = np.array(list(map(len, words)), np.int64)
    start = np.cumsum(size) - size
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if size.sum():
        owner = np.repeat(np.arange(len(size)), size)
        for s, n, q in runs(np.concatenate(ids), size):
            k = int(owner[s])
            found[k].append((s - int(start[k]), n, q))
    yield from zip(doc_ids, words, found)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, runs array of (start, length, period)): every run of every row's whole text, in the order of starts.

    Null, empty and blank texts have no runs; repeated rows and null ids are
    rows like any other; an empty table gives no rows; other columns are not
    read.  A task holds one block of texts, or one longer text.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids, texts = _ids(b["doc_id"]), utf8(b["text"])
            for p in blocks_of(list(map(len, texts))):
                rows = [(i, [{"start": s, "length": n, "period": q} for s, n, q in sorted(f)])
                        for i, _, f in _block(ids[p], texts[p], False)]
                yield _frame(rows, ["doc_id", "runs"])

    return _rows(docs, id_col, text_col).mapInPandas(
        run, "doc_id bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its number of runs, its strongest run, digests of all runs and of the collapsed text.

    One document in ten (by its id) is first given a made repetition.  A word
    is dropped from the collapsed text if a run holds it after that run's
    first period.  Null, empty and blank texts have no runs: 0, four nulls,
    digests of the empty string (the text without words is empty).  Repeated
    rows are reported alike; a null id gets no made repetition; an empty table
    gives no rows; other columns are not read.
    """
    prepare(docs.sparkSession)
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids, texts = _ids(b["doc_id"]), utf8(b["text"])
            for p in blocks_of(list(map(len, texts))):
                yield _frame([(i, *digest(f, w)) for i, w, f in _block(ids[p], texts[p], True)], names)

    return _rows(docs, id_col, text_col).mapInPandas(run, SCHEMA)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    # ids go as text: pandas turns whole numbers beside nulls into doubles
    return docs.select(F.col(id_col).cast("bigint").cast("string").alias("doc_id"), F.col(text_col).alias("text"))


def _ids(s: pd.Series) -> list:
    return [int(x) if isinstance(x, str) else None for x in s]


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=names, dtype=object)
    for c in names:
        if c not in ("runs", "runs_sha256", "collapsed_sha256"):
            out[c] = out[c].astype("Int64")
    return out

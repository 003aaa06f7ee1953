"""SimHash near-duplicates by deletion-variant signatures (operator 7).

A fingerprint of 64 bits is cut into fewer segments than the pigeonhole bound
asks for: with a bit distance of at most d and s = d // 2 + 1 segments, one
segment differs by at most one bit.  Every segment is indexed under each of
its one-wildcard variants (one bit masked), so two fingerprints within the
distance share at least one key; an equality exchange on the keys brings them
together and the full distance is verified there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import columns_of, fresh, materialize, prepare, stored, utf8

BITS = 64
SEED = 42


def fingerprint(text: bytes, words: int = 3) -> int:
    """SimHash of one text (bytes): A-Z lower-cased, runs of non-space bytes as words."""
    w = text.lower().split()
    if not w:
        return 0
    if len(w) <= words:
        grams = [b" ".join(w)]
    else:
        grams = list(map(b" ".join, zip(*(w[i:] for i in range(words)))))
    seen = np.zeros(BITS, np.int64)
    for lo in range(0, len(grams), 1 << 16):
        h = np.array([xxhash.xxh64_intdigest(g, SEED) for g in grams[lo:lo + (1 << 16)]], dtype="<u8")
        seen += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(seen * 2 > len(grams), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp bigint) of every row; null and blank texts get 0."""
    prepare(docs.sparkSession)
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), _fingerprint(words)(text_col).alias("fp"))


def _fingerprint(words: int):
    """The fingerprint (bigint) of a column of texts."""

    @F.pandas_udf("bigint")
    def run(text: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, words) for t in utf8(text)], dtype=np.uint64).view(np.int64))

    return run


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int16)


def bucket_links(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that connect one bucket's fingerprints exactly as all pairs within ``distance`` would.

    A breadth-first walk: each fingerprint taken from the queue is compared
    with those not reached yet, so a bucket of n gives fewer than n links.
    """
    left, links, queue = fps, [], []
    while len(left):
        if not queue:
            queue, left = [left[0]], left[1:]
            continue
        x = queue.pop()
        near = _popcount(left ^ x) <= distance
        if near.any():
            found = left[near]
            links += [(int(x), int(y)) for y in found]
            queue.extend(found)
            left = left[~near]
    return links


def _signatures(distance: int) -> list[tuple[int, int]]:
    """(segment mask, wildcard bit) of every signature."""
    s = distance // 2 + 1
    cuts = [round(BITS * i / s) for i in range(s + 1)]
    out = []
    for lo, hi in zip(cuts, cuts[1:]):
        mask = sum(1 << b for b in range(lo, hi))
        out += [(mask, b) for b in range(lo, hi)]
    return out


def links(fps: DataFrame, distance: int = 3) -> DataFrame:
    """(a, b): links between different fingerprints that connect all those within ``distance`` bits.

    ``fps`` has distinct fingerprints.  The links are enough for components:
    each key's bucket yields a spanning forest of its links, not all pairs.
    """
    prepare(fps.sparkSession)
    signed = lambda v: v - (1 << 64) if v >= 1 << 63 else v
    keys = F.array(*[F.struct(F.lit(i).alias("s"), F.col("fp").bitwiseAND(F.lit(signed(mask & ~(1 << bit)))).alias("v"))
                     for i, (mask, bit) in enumerate(_signatures(distance))])
    index = fps.select("fp", F.explode(keys).alias("k")).select(F.col("k.s").alias("s"), F.col("k.v").alias("v"), "fp")
    # keys are spread evenly by their hash: fingerprints are distinct, a key is shared by close ones only
    index = index.repartition("s", "v").sortWithinPartitions("s", "v", "fp")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def close(s, v, f):
            """Rows of complete buckets -> links."""
            if len(f) < 2:
                return None
            new = np.flatnonzero((s[1:] != s[:-1]) | (v[1:] != v[:-1])) + 1
            at = np.concatenate([[0], new])
            n = np.diff(np.concatenate([at, [len(f)]]))
            a = f[at[n == 2]]
            b = f[at[n == 2] + 1]
            ok = _popcount(a ^ b) <= distance
            more = [x for i, k in zip(at[n > 2], n[n > 2]) for x in bucket_links(f[i:i + k], distance)]
            extra = np.array(more, dtype=np.uint64).reshape(-1, 2)
            return pd.DataFrame({"a": np.concatenate([a[ok], extra[:, 0]]).view(np.int64),
                                 "b": np.concatenate([b[ok], extra[:, 1]]).view(np.int64)})

        held = [np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.uint64)]
        for p in batches:
            if not len(p):
                continue
            new = [p["s"].to_numpy(), p["v"].to_numpy(), p["fp"].to_numpy().view(np.uint64)]
            s, v, f = (np.concatenate(x) for x in zip(held, new))
            cut = np.flatnonzero((s != s[-1]) | (v != v[-1]))
            cut = int(cut[-1]) + 1 if len(cut) else 0
            out = close(s[:cut], v[:cut], f[:cut])
            held = [s[cut:], v[cut:], f[cut:]]
            if out is not None and len(out):
                yield out
        out = close(*held)
        if out is not None and len(out):
            yield out

    return index.mapInPandas(run, "a bigint, b bigint").dropDuplicates()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each node's component, for nodes that have a link.

    Alternating large-star and small-star steps on the link table; every round
    is materialised in the shared folder, and the loop ends when a round
    changes nothing.
    """
    e = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    if e.isEmpty():
        return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    while True:
        # large star: larger neighbours link to the smallest neighbour (or the node itself)
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # small star: smaller neighbours and the node link to the smallest one
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select("u", "v", "m")
        step = (small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                .union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        step = materialize(step)
        same = (step.count() == e.count()) and step.join(e, ["u", "v"], "left_anti").isEmpty()
        e = step
        if same:
            return e.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")


def near_duplicates(docs: DataFrame, words: int = 3, distance: int = 3, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs``.

    ``fingerprint`` is 16 lowercase hex digits; fingerprints link at
    ``distance`` or fewer differing bits, and ``component_id`` is the smallest
    doc_id reachable over links.  Null and blank texts have fingerprint zero
    and link like any other.  Copies share one fingerprint and are folded
    before any link is sought.  A null doc_id keeps its row; where a component
    has no other id, component_id is null.  An empty table gives no rows;
    other columns of ``docs`` are not read.
    """
    fp = stored(fingerprints(docs, words, id_col, text_col), "simhash")
    placed = _rooted(fp.groupBy("fp").agg(F.min("doc_id").alias("least")), distance)
    root = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    labelled = materialize(placed.join(root, "root").select("fp", "component_id"))
    return fp.join(labelled, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                          "component_id")


def _rooted(classes: DataFrame, distance: int) -> DataFrame:
    """(fp, least, root): each distinct fingerprint's row with the smallest fingerprint of its component."""
    found = components(links(classes.select("fp"), distance))
    return classes.join(found, classes.fp == found.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))


def keep_one(docs: DataFrame, words: int = 3, distance: int = 3) -> DataFrame:
    """The rows of ``docs`` of which exactly one of each near-duplicate component stays, whatever ids repeat or are null.

    It is the row with the smallest doc_id, null after all others; of rows
    that share it the smallest by a hash of the text, then of the whole row.
    Rows are told apart by a number of their own, not by their id.  Other
    columns pass, whatever their names.
    """
    prepare(docs.sparkSession)
    n, key, fp = fresh(docs, "__n", "__key", "__fp")
    cols = columns_of(docs)
    # columns of maps have no hash
    order = [c for c, (_, t) in zip(cols, docs.dtypes) if "map<" not in t]
    least = F.struct(F.col("doc_id").isNull().alias("gone"), F.col("doc_id").cast("bigint").alias("doc_id"),
                     F.xxhash64("text").alias("text"), F.xxhash64(*order).alias("row"))
    # one file holds the texts and the keys: a row's number stays the same in both reads
    rows = stored(docs.select(*cols, _fingerprint(words)("text").alias(fp), least.alias(key),
                              F.monotonically_increasing_id().alias(n)), "simhash-rows")
    keys = rows.select(F.col(fp).alias("fp"), F.struct(f"{key}.*", F.col(n).alias("n")).alias("key"))
    placed = _rooted(keys.groupBy("fp").agg(F.min("key").alias("least")), distance)
    kept = placed.groupBy("root").agg(F.min("least").alias("least")).select(F.col("least.n").alias(n))
    return rows.join(kept, n, "left_semi").select(*cols)

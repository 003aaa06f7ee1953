"""Bit-plane clustering and periodic runs against brute force, on small tables with odd rows."""

import hashlib
import os
import re
import sys
import zlib

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from oracle_compare import compare, duck  # noqa: E402
from tidecast.llm import bitplanes, common, periods  # noqa: E402

SF = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- 12: bit planes
def test_clusters_equal_the_sql(spark):
    name = "op12_bit_planes"
    assert compare(spark, name, E.queries()[name], E.oracle_sql()[name], SF, duck(SF))["ok"]


@pytest.mark.parametrize("low, high", [(-300, 300), (-2**40, 2**40), (-2**63, 2**63 - 1), (0, 1), (-1, 0)])
def test_plane_products_are_exact(low, high):
    rng = np.random.default_rng(0)
    x, c = rng.integers(low, high, (40, 64), endpoint=True), rng.integers(low, high, (5, 64), endpoint=True)
    a, b = bitplanes.pack(x, bitplanes.plane_count(x)), bitplanes.pack(c, bitplanes.plane_count(c))
    xo, co = x.astype(object), c.astype(object)
    assert (bitplanes.dots(a, b) == xo @ co.T).all()
    far = ((xo[:, None, :] - co[None]) ** 2).sum(2)
    number, least = bitplanes.nearest(a, c.tolist())
    assert (number == far.argmin(1)).all() and (least == far.min(1)).all()


def lloyd(rows, k, rounds):
    """The contract in plain Python over (vec_id, integer components)."""
    cent = [v for _, v in sorted(((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in rows if i is not None))[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cent))
    for _ in range(rounds):
        mine = [near(v)[1] for _, v in rows]
        for n in range(len(cent)):
            part = [v for (_, v), m in zip(rows, mine) if m == n]
            if part:
                cent[n] = [sum(x) // len(part) for x in zip(*part)]
    placed = [(i, *near(v)[::-1]) for i, v in rows]
    return placed, cent


VEC = "vec_id bigint, embedding array<double>, label int, cluster int, distance string, `a.b` int"


def test_clusters_of_odd_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), rng.normal(0, 2, 64).tolist()) for i in range(60)]
    rows += [rows[3], rows[3], (7, rng.normal(0, 2, 64).tolist()), (None, rows[9][1]), (70, [1e9] * 64)]
    odd = [(100, None), (101, [1.0] * 63), (102, [1.0] * 63 + [None]), (103, [1.0] * 63 + [float("nan")]),
           (104, [float("inf")] * 64), (105, [])]
    df = spark.createDataFrame([(i, v, 1, 2, "x", 3) for i, v in rows + odd], VEC).repartition(3)
    want, cent = lloyd([(i, [int(np.floor(64 * x)) for x in v]) for i, v in rows], 16, 3)
    got = bitplanes.cluster(df).collect()
    fits = lambda x: x if x < 2**63 else None
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0)
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in got), key=key) == \
        sorted(((i, n, fits(d)) for i, n, d in want), key=key)
    for r in got:
        assert r.cluster_inertia == fits(sum(d for _, n, d in want if n == r.cluster))
        assert r.inertia == fits(sum(d for _, _, d in want))
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, cent[r.cluster])).encode()).hexdigest()
    assert bitplanes.cluster(df.where("vec_id >= 100")).count() == 0
    assert bitplanes.cluster(df.limit(0)).count() == 0
    few = bitplanes.cluster(df.where("vec_id < 3")).collect()
    assert sorted(r.cluster for r in few) == [0, 1, 2] and all(r.distance == 0 for r in few)
    huge = spark.createDataFrame([(1, [1e300] * 64), (2, [-1e300] * 64)], "vec_id bigint, embedding array<double>")
    assert sorted(r.distance for r in bitplanes.cluster(huge).collect()) == [0, 0]


# ---------------------------------------------------------------- 13: periodic runs
def brute(w, least=6, factor=4):
    """All runs by every lag, kept if no smaller lag covers the stretch."""
    n, out = len(w), []
    for q in range(1, n // factor + 1):
        i = q
        while i < n:
            if w[i] != w[i - q]:
                i += 1
                continue
            b = i
            while i < n and w[i] == w[i - q]:
                i += 1
            s, size = b - q, i - b + q
            if size >= max(least, factor * q) and not any(
                    all(w[j] == w[j - p] for j in range(s + p, s + size)) for p in range(1, q)):
                out.append((s, size, q))
    return sorted(out)


def test_runs_of_many_small_texts():
    rng = np.random.default_rng(0)
    for _ in range(600):
        texts = []
        for _ in range(rng.integers(1, 5)):
            n = int(rng.integers(0, 90))
            w = rng.integers(0, rng.integers(1, 6), n)
            for _ in range(rng.integers(0, 4) if n else 0):
                a, p = int(rng.integers(0, n)), int(rng.integers(1, 12))
                at = np.arange(a, int(rng.integers(a, n + 1)))
                w[at] = w[np.minimum(a + (at - a) % p, n - 1)]
            texts.append(w.astype(np.int64))
        size = np.array([len(x) for x in texts])
        start = np.cumsum(size) - size
        want = sorted((int(s + a), n, q) for x, s in zip(texts, start) for a, n, q in brute(x.tolist()))
        assert sorted(periods.runs(np.concatenate(texts), size)) == want


def contract(doc_id, text):
    """The contract's row of one document, word by word."""
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if n and doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        if h % 10 == 0:
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute(w)
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{size},{q}\n" for s, size, q in found)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_runs_of_the_query_equal_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in common.documents(spark, SF).collect() if len(r.text or "") < 6000]
    got = {r.doc_id: tuple(r) for r in E.queries()["op13_periodic_runs"](spark, SF).collect()}
    assert len(got) == common.documents(spark, SF).count()
    assert any(got[i][1] for i, _ in docs)
    for i, t in docs:
        assert got[i] == contract(i, t)


def test_runs_of_odd_rows(spark):
    made = next(i for i in range(10, 1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    texts = [(1, None), (2, ""), (3, " \n\t "), (4, "a a a a a a"), (4, "a a a a a a"), (5, "a a a a a"),
             (6, "x ab cd ab cd ab cd ab cd y"), (made, " ".join(f"w{i}" for i in range(500))), (None, "b b b b b b b c"),
             (2**60 + 1, "\x1c\x1c \x1c\x1c é é é é é é\r\né\x0b7"), (8, "one")]
    df = spark.createDataFrame([(i, t, 9, "z") for i, t in texts],
                               "doc_id bigint, text string, n_runs int, start string").repartition(3)
    key = lambda r: (r[0] is None, r)
    assert sorted(map(tuple, periods.report(df).collect()), key=key) == sorted((contract(*r) for r in texts), key=key)
    assert periods.report(df.limit(0)).count() == 0 and periods.periodic_runs(df.limit(0)).count() == 0
    spans = {r.doc_id: [tuple(x) for x in r.runs] for r in periods.periodic_runs(df).collect()}
    assert spans[6] == [(1, 8, 2)] and spans[1] == spans[8] == [] and spans[None] == [(0, 7, 1)]


@pytest.mark.parametrize("text, found", [("same " * 300_000, [(0, 300_000, 1)]), ("a b " * 150_000, [(0, 300_000, 2)]),
                                         (" ".join(str(i % 70_000) for i in range(300_000)), [(0, 300_000, 70_000)])])
def test_runs_of_very_long_texts(spark, text, found):
    df = spark.createDataFrame([(3, text)], "doc_id bigint, text string")
    assert [tuple(x) for x in periods.periodic_runs(df).first().runs] == found

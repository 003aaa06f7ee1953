"""Centroid clustering by bit-plane popcounts (operator 12).

A vector of 64 integer components is kept as bit planes: plane b is one uint64
that holds bit b of all components, in two's complement, so the highest plane
weighs -2^b.  The dot product of two vectors is then the sum over pairs of
planes of their weights' product times popcount(plane AND plane), an exact
integer, and so are squared lengths and distances.  A centroid's next place
needs only counts of set bits, one per plane and component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import prepare, stored

WIDTH = 64
_SHIFT = np.arange(WIDTH, dtype=np.uint64)


def plane_count(x: np.ndarray) -> int:
    """Planes that two's complement needs for every value of ``x``."""
    if not x.size:
        return 1
    low, high = int(x.min()), int(x.max())
    return 1 + max(max(0, high).bit_length(), (~min(0, low)).bit_length() if low < 0 else 0)


def pack(x: np.ndarray, planes: int) -> np.ndarray:
    """Bit planes [row, plane] of integer rows of 64 components."""
    u = np.ascontiguousarray(x, np.int64).view(np.uint64)
    out = np.empty((len(u), planes), np.uint64)
    for b in range(planes):
        out[:, b] = np.bitwise_or.reduce(((u >> np.uint64(b)) & np.uint64(1)) << _SHIFT, axis=1)
    return out


def weights(planes: int) -> list[int]:
    return [1 << b for b in range(planes - 1)] + [-(1 << (planes - 1))]


def dots(a: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact dot products [row of a, row of c] of bit planes; Python integers where 64 bits could overflow."""
    wa, wc = weights(a.shape[1]), weights(c.shape[1])
    wide = a.shape[1] + c.shape[1] + 7 > 62
    out = np.zeros((len(a), len(c)), object if wide else np.int64)
    for i, x in enumerate(wa):
        for j, y in enumerate(wc):
            ones = np.bitwise_count(a[:, i, None] & c[None, :, j])
            out += ones.astype(out.dtype) * (x * y)
    return out


def squares(a: np.ndarray) -> np.ndarray:
    """Exact squared length of every row of bit planes."""
    w = weights(a.shape[1])
    wide = 2 * a.shape[1] + 7 > 62
    out = np.zeros(len(a), object if wide else np.int64)
    for i, x in enumerate(w):
        for j in range(i, len(w)):
            ones = np.bitwise_count(a[:, i] & a[:, j]).astype(out.dtype)
            out += ones * (x * w[j] * (1 if i == j else 2))
    return out


def nearest(a: np.ndarray, centroids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, ties to the smaller; exact squared distance) of every row of bit planes."""
    rows = np.array(centroids, np.int64).reshape(-1, WIDTH)
    c = pack(rows, plane_count(rows))
    # |v|^2 is the same for all centroids of a row
    far = squares(c).astype(object)[None, :] - 2 * dots(a, c) if 2 * (a.shape[1] + c.shape[1]) > 54 \
        else squares(c)[None, :] - 2 * dots(a, c)
    which = np.argmin(far, axis=1) if len(a) else np.zeros(0, np.int64)
    return which, squares(a) + far[np.arange(len(a)), which]


def bit_counts(a: np.ndarray, which: np.ndarray, k: int) -> np.ndarray:
    """Rows with a set bit, [cluster, plane, component]."""
    out = np.zeros((k, a.shape[1], WIDTH), np.int64)
    for c in np.unique(which):
        part = np.ascontiguousarray(a[which == c]).view(np.uint8).reshape(-1, a.shape[1], 8)
        out[c] = np.unpackbits(part, axis=2, bitorder="little").sum(0, dtype=np.int64)
    return out


def _planes_of(raw) -> np.ndarray:
    return np.frombuffer(b"".join(raw), np.uint64).reshape(len(raw), -1)


def integer_vectors(vectors: DataFrame, scale: float = 64.0, id_col: str = "vec_id",
                    vec_col: str = "embedding") -> DataFrame:
    """(vec_id, v array<bigint>) of the vectors with exactly 64 components, none null or non-finite.

    A component x becomes floor(scale * x), x as double; beyond 64 bits it is
    the end of their range.
    """
    x = F.transform(F.col(vec_col), lambda e: e.cast("double"))
    whole = (F.size(vec_col) == WIDTH) & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    # a double beyond 64 bits must not raise under ANSI rules
    def floored(e):
        s = F.floor(F.lit(scale) * e)
        y = F.lit(scale) * e
        return F.when(y >= 2.0 ** 63, F.lit(2 ** 63 - 1)).when(y < -(2.0 ** 63), F.lit(-(2 ** 63))).otherwise(s)
    return vectors.where(F.coalesce(whole, F.lit(False))).select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.transform(x, floored).alias("v"))


def first_centroids(rows: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The k vectors with the smallest sha256 of ``seed:vec_id``; repeated ids in the order of their components."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    top = rows.where("vec_id IS NOT NULL").orderBy(key, "v").limit(k).select("v").collect()       # k rows
    return [list(r.v) for r in top]


def _sums(packed: DataFrame, centroids: list[list[int]]) -> dict[int, tuple[int, list[int]]]:
    """{cluster: (rows, component sums)} of the non-empty clusters; each task sends one row per cluster and component."""
    k = len(centroids)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, bits = np.zeros(k, np.int64), {}
        for b in batches:
            if not len(b):
                continue
            for size, raw in b.groupby(b["planes"].map(len))["planes"]:     # rows of one number of planes
                a = _planes_of(list(raw))
                which, _ = nearest(a, centroids)
                n += np.bincount(which, minlength=k)
                bits[size] = bits.get(size, 0) + bit_counts(a, which, k)
        out = []
        for c in np.flatnonzero(n):
            total = [0] * WIDTH
            for size, counts in bits.items():
                for w, ones in zip(weights(size // 8), counts[c].tolist()):
                    total = [t + w * o for t, o in zip(total, ones)]
            out += [(int(c), j, int(n[c]), Decimal(t)) for j, t in enumerate(total)]
        yield pd.DataFrame(out, columns=["cluster", "j", "n", "total"])

    got = packed.select("planes").mapInPandas(run, "cluster int, j int, n bigint, total decimal(38,0)") \
        .groupBy("cluster", "j").agg(F.sum("n").alias("n"), F.sum("total").alias("total")) \
        .collect()                                            # k * 64 rows
    out: dict[int, tuple[int, list[int]]] = {}
    for r in got:
        out.setdefault(r.cluster, (r.n, [0] * WIDTH))[1][r.j] = int(r.total)
    return out


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, seed: int = 1, scale: float = 64.0,
            id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector.

    Lloyd's rounds in exact integers: centroids start as the k vectors with
    the smallest hash of their id, each round assigns every vector to the
    nearest centroid (ties: smaller number) and moves each non-empty centroid
    to the componentwise floor of the mean; then vectors are assigned once
    more.  The vectors are written once as bit planes; a round reads them and
    brings k * 64 sums to the driver.

    Vectors that are null, of another length or hold a null or non-finite
    component take no part.  A null id is clustered but never a first
    centroid.  Repeated rows count as often as they occur.  With fewer than k
    vectors there are fewer centroids; without any (no table rows, or no row
    with an id) there are no rows.  Distances and inertias beyond 64 bits are
    null.  Other columns are not read.
    """
    spark = prepare(vectors.sparkSession)
    rows = integer_vectors(vectors, scale, id_col, vec_col)

    @F.pandas_udf("binary")
    def planes(v: pd.Series) -> pd.Series:
        x = np.array(list(v), np.int64).reshape(-1, WIDTH)
        # planes of one batch; another batch may need more
        return pd.Series([r.tobytes() for r in pack(x, plane_count(x))], dtype=object)

    centroids = first_centroids(rows, k, seed)
    schema = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    if not centroids:
        return spark.createDataFrame([], schema)
    packed = stored(rows.select("vec_id", planes("v").alias("planes")), "bit-planes")
    for _ in range(rounds):
        for c, (n, total) in _sums(packed, centroids).items():
            centroids[c] = [t // n for t in total]
    final = [list(c) for c in centroids]

    @F.pandas_udf("struct<cluster:int,distance:decimal(38,0)>")
    def assign(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            number, far = np.zeros(len(s), np.int32), np.empty(len(s), object)
            sizes = s.map(len).to_numpy()
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                number[at], far[at] = nearest(_planes_of(list(s.iloc[at])), final)
            yield pd.DataFrame({"cluster": number, "distance": [Decimal(int(d)) for d in far]})

    placed = stored(packed.select("vec_id", assign("planes").alias("a")).select("vec_id", "a.cluster", "a.distance"),
                    "clusters")
    per = placed.groupBy("cluster").agg(F.sum("distance").alias("ci")).collect()               # k rows
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in final]
    whole = Decimal(sum(int(r.ci) for r in per))
    table = spark.createDataFrame([(r.cluster, Decimal(int(r.ci)), whole, digest[r.cluster]) for r in per],
                                  "cluster int, ci decimal(38,0), whole decimal(38,0), centroid_sha256 string")
    fits = lambda c: F.when(F.col(c) <= 2 ** 63 - 1, F.col(c)).cast("bigint")
    return placed.join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", fits("distance").alias("distance"), fits("ci").alias("cluster_inertia"),
        fits("whole").alias("inertia"), "centroid_sha256")


def sql(k: int = 16, rounds: int = 3, seed: int = 1) -> str:
    """DuckDB SQL for :func:`cluster` over ``embeddings``."""
    near = """SELECT vec_id, v, n, d FROM (SELECT r.vec_id, r.rid, r.v, c.n, c.d,
              row_number() OVER (PARTITION BY r.rid ORDER BY c.d, c.n) AS rk FROM rows_ r JOIN LATERAL (
              SELECT c0.n, list_sum([(r.v[i] - c0.c[i]) * (r.v[i] - c0.c[i]) FOR i IN range(1, 65)]) AS d
              FROM c{t} c0) c ON true) WHERE rk = 1"""
    parts = [f"""rows_ AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS rid,
        [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
        WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = 64)""",
             f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS n, v AS c
        FROM rows_ ORDER BY sha256('{seed}:' || vec_id) LIMIT {k})"""]
    for t in range(rounds):
        parts.append(f"a{t} AS MATERIALIZED ({near.format(t=t)})")
        parts.append(f"""c{t + 1} AS MATERIALIZED (SELECT o.n, coalesce(m.c, o.c) AS c FROM c{t} o LEFT JOIN (
            SELECT n, list((s - ((s % k + k) % k)) // k ORDER BY j) AS c FROM (
            SELECT n, j, CAST(sum(v[j]) AS BIGINT) AS s, count(*) AS k FROM a{t}, range(1, 65) g(j) GROUP BY n, j)
            GROUP BY n) m ON m.n = o.n)""")
    return "WITH " + ",\n".join([*parts, f"a{rounds} AS MATERIALIZED ({near.format(t=rounds)})"]) + f"""
        SELECT a.vec_id, CAST(a.n AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance,
        CAST(sum(a.d) OVER (PARTITION BY a.n) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
        sha256(array_to_string(c.c, ',')) AS centroid_sha256 FROM a{rounds} a JOIN c{rounds} c ON c.n = a.n"""

"""Approximate nearest neighbours over learned partitions (operator 9).

A bounded sample of vectors is joined to a neighbour graph, the graph is cut
into balanced partitions, and a small classifier learns to tell a vector's
partition.  Every row is placed by the classifier; a query goes to its most
probable partitions, whose rows are reranked by the exact cosine.
"""

from __future__ import annotations

import functools
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.llm.common import prepare, ragged_ranges, stored

#: Rows of the sample on which the partitions are learned, and those of them that only try the router.
SAMPLE, TRIED = 6000, 400
#: Rows a partition, and the least and greatest number of partitions (the sample has to tell them apart).
PART_ROWS, PARTITIONS, MOST = 4000, 16, 256
#: Share of the tried rows' nearest others that the probed partitions must hold.
TARGET = 0.95
NEIGHBOURS = 10
#: Partitions are compared in so many cells at most: a query goes once to each cell that holds one of its partitions.
CELLS = 64
#: Rows of a cell, and queries, that one task compares; queries are held in memory in at most so many bytes, rows stream past them.
BLOCK, QUERY_BLOCK, QUERY_BYTES = 1_000_000, 300_000, 160 << 20
#: Rows and queries of one matrix product, and pairs whose exact cosine is taken at once.
ROWS_AT_ONCE, QUERIES_AT_ONCE, PAIRS_AT_ONCE = 2048, 256, 1 << 16


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest others of each row by cosine (rows have length one)."""
    n = len(x)
    k = min(k, n - 1)
    out = np.zeros((n, max(k, 0)), np.int64)
    for lo in range(0, n, 1024):
        s = x[lo:lo + 1024] @ x.T
        s[np.arange(len(s)), np.arange(lo, lo + len(s))] = -2
        out[lo:lo + 1024] = np.argpartition(-s, k - 1, axis=1)[:, :k] if k else out[lo:lo + 1024]
    return out


def balanced_partition(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12, slack: float = 1.1,
                       seed: int = 3) -> np.ndarray:
    """Partition number of each row: few graph edges cut, at most ``slack`` of the even share a part.

    Starts from balanced nearest centres, then moves rows to the partition
    that most of their neighbours (both ways) are in, best gains first, while
    it has room.
    """
    n = len(x)
    rng = np.random.default_rng(seed)
    room = int(np.ceil(slack * n / parts))
    centres = x[rng.choice(n, parts, replace=False)]
    part = np.zeros(n, np.int64)
    for _ in range(6):
        score = x @ centres.T
        part = _fill(score, room)
        for p in range(parts):
            if (part == p).any():
                c = x[part == p].sum(0)
                centres[p] = c / max(np.linalg.norm(c), 1e-12)
    if graph.shape[1]:
        a = np.repeat(np.arange(n), graph.shape[1])
        b = graph.ravel()
        for _ in range(rounds):
            votes = np.zeros((n, parts))
            np.add.at(votes, (a, part[b]), 1)
            np.add.at(votes, (b, part[a]), 1)
            want = votes.argmax(1)
            gain = votes[np.arange(n), want] - votes[np.arange(n), part]
            size = np.bincount(part, minlength=parts)
            moved = 0
            for i in np.argsort(-gain, kind="stable"):
                if gain[i] <= 0:
                    break
                if size[want[i]] < room and rng.random() < 0.7:
                    size[part[i]] -= 1
                    size[want[i]] += 1
                    part[i] = want[i]
                    moved += 1
            if not moved:
                break
    return part


def _fill(score: np.ndarray, room: int) -> np.ndarray:
    """Each row to its best partition that has room, surest rows first."""
    n, parts = score.shape
    order = np.argsort(-score.max(1), kind="stable")
    prefer = np.argsort(-score, axis=1)
    size, out = np.zeros(parts, np.int64), np.zeros(n, np.int64)
    for i in order:
        for p in prefer[i]:
            if size[p] < room:
                out[i] = p
                size[p] += 1
                break
    return out


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings the largest component near 1: no square over- or underflows, no digit changes."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1]) if len(x) else x


def unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Router:
    """One hidden layer and a softmax over partitions; a query is sent to the most probable ones that hold ``mass``."""

    mass = 1.0

    def __init__(self, weights):
        self.weights = weights

    def place(self, x: np.ndarray) -> np.ndarray:
        return self.logits(x).argmax(1)

    def probes(self, x: np.ndarray) -> list[np.ndarray]:
        """Partitions of each row, the most probable first."""
        z = self.logits(x)
        z = np.exp(z - z.max(1, keepdims=True))
        z /= z.sum(1, keepdims=True)
        order = np.argsort(-z, axis=1, kind="stable")
        before = np.cumsum(np.take_along_axis(z, order, 1), 1) - np.take_along_axis(z, order, 1)
        return [o[:max(1, int(n))].astype(np.int32) for o, n in zip(order, (before < self.mass).sum(1))]

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.maximum(x @ w1 + b1, 0) @ w2 + b2


def train_router(x: np.ndarray, target: np.ndarray, hidden: int = 128, epochs: int = 40, seed: int = 4) -> Router:
    """Learn the share of each row's neighbourhood that lies in each partition."""
    rng = np.random.default_rng(seed)
    d, k = x.shape[1], target.shape[1]
    w = [rng.normal(0, (2 / d) ** 0.5, (d, hidden)), np.zeros(hidden), rng.normal(0, hidden ** -0.5, (hidden, k)), np.zeros(k)]
    m, v = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for lo in range(0, len(x), 256):
            rows = order[lo:lo + 256]
            h = np.maximum(x[rows] @ w[0] + w[1], 0)
            z = h @ w[2] + w[3]
            z = np.exp(z - z.max(1, keepdims=True))
            g = (z / z.sum(1, keepdims=True) - target[rows]) / len(rows)
            back = (g @ w[2].T) * (h > 0)
            grads = [x[rows].T @ back + 1e-4 * w[0], back.sum(0), h.T @ g + 1e-4 * w[2], g.sum(0)]
            step += 1
            for i, gr in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * gr
                v[i] = 0.999 * v[i] + 0.001 * gr * gr
                w[i] = w[i] - 0.003 * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
    return Router(w)


def learn(sample: np.ndarray, parts: int = PARTITIONS, target: float = TARGET, seed: int = 5) -> Router | None:
    """A router from sample vectors; with fewer than 4 rows a partition there are fewer partitions, None below two.

    Some of the sample's rows take no part in the fit: the router's mass is
    the least with which the partitions probed for them hold ``target`` of
    their nearest others in the sample.  Vectors in clusters need few
    partitions, vectors alike in all directions nearly all.
    """
    x = np.unique(unit(sample), axis=0)
    x = x[np.random.default_rng(seed).permutation(len(x))]
    parts = min(parts, len(x) // 4)
    if parts < 2:
        return None
    held = min(TRIED, len(x) // 10)
    fit = x[held:]
    graph = neighbour_graph(fit, NEIGHBOURS)
    part = balanced_partition(fit, graph, parts)
    share = np.zeros((len(fit), parts))
    np.add.at(share, (np.repeat(np.arange(len(fit)), graph.shape[1]), part[graph].ravel()), 1.0)
    share[np.arange(len(fit)), part] += 2.0
    router = train_router(fit, share / share.sum(1, keepdims=True))
    if held:
        s = x[:held] @ x.T
        s[np.arange(held), np.arange(held)] = -2
        near = router.place(x)[np.argsort(-s, axis=1, kind="stable")[:, :5]]
        for mass in (0.5, 0.6, 0.7, 0.8, 0.85, 0.9, 0.93, 0.95, 0.97, 0.98, 0.99, 0.995, 0.999, 0.9999, 1.0):
            router.mass = mass
            if np.mean([np.isin(n, p).mean() for n, p in zip(near, router.probes(x[:held]))]) >= target:
                break
    return router


@functools.lru_cache(maxsize=2)
def _router(model: bytes) -> Router | None:
    return pickle.loads(model)


def _usable(vectors: DataFrame, id_col: str, vec_col: str, kind: str) -> DataFrame:
    """(id, v array<kind>) of the vectors that take part: no null or non-finite component, not zero."""
    v = F.col(vec_col).cast(f"array<{kind}>")
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), v.alias("v")).where("id IS NOT NULL AND v IS NOT NULL")
    finite = F.forall("v", lambda c: F.abs(c) < F.lit(float("inf")).cast(kind))     # NaN is no less; a null makes it null
    return rows.where(finite).where(F.exists("v", lambda c: c != 0))


def _kind(vectors: DataFrame, queries: DataFrame, vec_col: str) -> str:
    """Components stay floats where both tables hold floats (half the bytes, the same numbers); else they are doubles."""
    types = [df.select(vec_col).schema[0].dataType for df in (vectors, queries)]
    return "float" if all(isinstance(t, T.ArrayType) and isinstance(t.elementType, T.FloatType) for t in types) else "double"


def _sampled(vectors: DataFrame, id_col: str, vec_col: str, kind: str, sample: int, n: int) -> list[list[float]]:
    """Vectors of the ``sample`` usable rows (of ``n``) with the least hash of the id.

    Only rows under a bound on the hash are sorted, about twice as many as
    asked for; where ids repeat so that too few are under it, it is raised.
    The executors bring the tasks' rows together, the driver gets the sample.
    """
    share = 2 * sample / max(n, 1)
    while True:
        low = vectors if share >= 1 else vectors.where(
            F.xxhash64(F.col(id_col).cast("bigint")) <= int(share * 2.0**64) - 2**63)
        rows = _usable(low, id_col, vec_col, kind).orderBy(F.xxhash64("id"), "id").limit(sample).select("v")
        got = [r.v for r in stored(rows, "ann-sample").collect()]
        if share >= 1 or len(got) >= sample:
            return got
        share *= 8


def _matrix(v: pa.Array, width: int) -> np.ndarray:
    """Vectors of one length as rows, in the type they are held in."""
    return v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), width)


def _lengths(v: pa.Array) -> np.ndarray:
    return pc.list_value_length(v).to_numpy(zero_copy_only=False).astype(np.int32)


def _routed(v: pa.Array, width: int, router: Router | None, all_of: bool) -> list[np.ndarray] | np.ndarray:
    """Partition of each vector, or all that it is sent to; vectors of another length are in a partition of their own."""
    n = _lengths(v)
    mine = n == width
    home = np.where(mine, 0, -n).astype(np.int32)
    if router is not None and mine.any():
        x = unit(_matrix(v.filter(pa.array(mine)), width).astype(np.float64))
        if all_of:
            probes = iter(router.probes(x))
            return [next(probes) if m else home[i:i + 1] for i, m in enumerate(mine)]
        home[mine] = router.place(x)
    return list(home[:, None]) if all_of else home


def _by_cell(probes: list[np.ndarray], cells: int) -> pa.Array:
    """For each row its cells, each with the row's partitions there."""
    row = np.repeat(np.arange(len(probes)), np.array([len(p) for p in probes], np.int64))
    part = np.concatenate([*probes, np.zeros(0, np.int32)]).astype(np.int32)
    cell = np.mod(part, cells).astype(np.int32)
    order = np.lexsort((part, cell, row))
    row, part, cell = row[order], part[order], cell[order]
    first = np.flatnonzero(np.r_[[True] * (len(row) > 0), (row[1:] != row[:-1]) | (cell[1:] != cell[:-1])])
    lists = pa.ListArray.from_arrays(pa.array(np.r_[first, len(row)].astype(np.int32)), pa.array(part))
    ends = np.cumsum(np.bincount(row[first], minlength=len(probes)))
    return pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.StructArray.from_arrays(
        [pa.array(cell[first]), lists], ["cell", "probes"]))


def cosines(q: np.ndarray, q_norm: np.ndarray, x: np.ndarray, x_norm: np.ndarray) -> np.ndarray:
    """Cosine of each pair of rows, in double precision, the same whatever stands around the rows."""
    return (q * x).sum(1) / (q_norm * x_norm)


def norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(1))


class Block:
    """Queries of one length that one task compares, with the ``k`` nearest rows found so far, ties to the smaller id.

    A product of matrices in single precision finds the pairs that may be among
    a query's nearest, with a margin above its rounding; their scores are then
    computed pair by pair in double precision.  Equal vectors of a batch of
    rows are compared once.  A row is no candidate for the query of its own id.
    """

    def __init__(self, ids: np.ndarray, v: np.ndarray, k: int):
        n, width = v.shape
        self.ids, self.v, self.k = ids, v, k
        self.unit, self.norm, self.power = np.empty(v.shape, np.float32), np.empty(n), np.empty((n, 1), np.int32)
        step = max(1, (8 << 20) // (8 * width))
        for lo in range(0, n, step):
            x = v[lo:lo + step].astype(np.float64)
            self.power[lo:lo + step] = np.frexp(np.abs(x).max(1, keepdims=True))[1]
            x = scaled(x)
            self.norm[lo:lo + step] = norms(x)
            self.unit[lo:lo + step] = unit(x)
        #: Twice the bound of what rounding to single precision changes in a cosine.
        self.margin = (width + 8) * 2.0**-23
        self.score = np.full((n, k), -np.inf)
        self.found = np.full((n, k), np.iinfo(np.int64).max)
        self.least = np.full(n, -np.inf, np.float32)       # a nearer row has this cosine at least

    def add(self, asked: np.ndarray, ids: np.ndarray, v: np.ndarray) -> None:
        """Compare a batch of rows with the queries numbered ``asked``."""
        v = scaled(v.astype(np.float64))
        order = np.argsort(ids, kind="stable")
        ids, v = ids[order], v[order]
        _, first, owner = np.unique(np.ascontiguousarray(v).view(f"V{v.shape[1] * 8}").ravel(), return_index=True, return_inverse=True)
        by = np.argsort(owner.ravel(), kind="stable")        # rows of each distinct vector, ids ascending
        size = np.bincount(owner.ravel(), minlength=len(first))
        # a query's own rows don't count: so many of them are among these
        own, times = np.unique(ids, return_counts=True)
        at = np.minimum(np.searchsorted(own, self.ids[asked]), len(own) - 1)
        spare = self.k + np.where(own[at] == self.ids[asked], times[at], 0)
        groups = ids[by], np.cumsum(size) - size, np.minimum(size, spare.max(initial=0))
        x = v[first]
        x_norm, columns = norms(x), np.ascontiguousarray(unit(x).astype(np.float32).T)
        m = len(x)
        product = np.empty((QUERIES_AT_ONCE, m), np.float32)
        rows, cols, held = [], [], 0
        for lo in range(0, len(asked), QUERIES_AT_ONCE):
            mine = asked[lo:lo + QUERIES_AT_ONCE]
            s = np.matmul(self.unit[mine], columns, out=product[:len(mine)])
            least = self.least[mine]
            short = np.flatnonzero(least == -np.inf)         # fewer than k found so far
            if len(short) and (take := spare[lo:lo + QUERIES_AT_ONCE][short].max()) < m:
                least[short] = np.partition(s[short], m - take, axis=1)[:, m - take] - np.float32(self.margin)
            some = np.flatnonzero(s.max(1) >= least)          # most queries have no nearer row in a batch
            if len(some):
                r, c = np.divmod(np.flatnonzero(s[some] >= least[some, None]), m)
                rows.append(mine[some[r]])
                cols.append(c)
                held += len(r)
            if held >= 4 * PAIRS_AT_ONCE:
                self._settle(rows, cols, x, x_norm, groups)
                rows, cols, held = [], [], 0
        if held:
            self._settle(rows, cols, x, x_norm, groups)

    def _settle(self, rows: list, cols: list, x: np.ndarray, x_norm: np.ndarray, groups: tuple) -> None:
        rows, cols = np.concatenate(rows), np.concatenate(cols)
        ids, start, size = groups
        step = max(1, min(PAIRS_AT_ONCE, (32 << 20) // (8 * x.shape[1])))
        for lo in range(0, len(rows), step):
            r, c = rows[lo:lo + step], cols[lo:lo + step]
            score = cosines(np.ldexp(self.v[r].astype(np.float64), -self.power[r]), self.norm[r], x[c], x_norm[c])
            last = self.score[r, -1]
            near = (score > last) | (score == last) & (ids[start[c]] < self.found[r, -1])
            r, c, score = r[near], c[near], score[near]
            some = ids[ragged_ranges(start[c], size[c])]
            r, score = np.repeat(r, size[c]), np.repeat(score, size[c])
            other = some != self.ids[r]
            if other.any():
                self._merge(r[other], some[other], score[other])

    def _merge(self, rows: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        k = self.k
        mine, of = np.unique(rows, return_inverse=True)
        of = np.concatenate([of.ravel(), np.repeat(np.arange(len(mine)), k)])
        ids = np.concatenate([ids, self.found[mine].ravel()])
        score = np.concatenate([score, self.score[mine].ravel()])
        order = np.lexsort((ids, -score, of))
        size = np.bincount(of, minlength=len(mine))
        top = order[(np.cumsum(size) - size)[:, None] + np.arange(k)]     # every query has k entries at least
        self.found[mine], self.score[mine] = ids[top], score[top]
        self.least[mine] = self.score[mine, -1] - self.margin

    def nearest(self, step: int = 10_000) -> Iterator[pa.RecordBatch]:
        """query_id and best, array<struct<s, i>> by -score and id, of the queries that found a row."""
        some = np.flatnonzero(self.score[:, 0] > -np.inf)
        for lo in range(0, len(some), step):
            mine = some[lo:lo + step]
            full = self.score[mine] > -np.inf
            best = pa.StructArray.from_arrays([pa.array(-self.score[mine][full]), pa.array(self.found[mine][full])], ["s", "i"])
            ends = np.r_[0, np.cumsum(full.sum(1))].astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(self.ids[mine]), pa.ListArray.from_arrays(pa.array(ends), best)], ["query_id", "best"])


class Task:
    """What one task compares: queries come first, then its rows by partition."""

    def __init__(self, k: int):
        self.k, self.queries, self.blocks = k, [], None
        self.part, self.rows, self.held = None, [], 0

    def ask(self, batch: pa.RecordBatch) -> None:
        self.queries.append(batch)

    def _arrange(self) -> None:
        """Blocks by length, and by partition the queries sent to it."""
        self.blocks, self.sent = {}, {}
        if self.queries:
            got = pa.Table.from_batches(self.queries).combine_chunks()
            self.queries = []
            ids, v, probes = (got[c].combine_chunks() if got.num_rows else None for c in ("id", "v", "probes"))
            n = _lengths(v)
            of, part = np.repeat(np.arange(len(n)), _lengths(probes)), probes.flatten().to_numpy(zero_copy_only=False)
            place = np.empty(len(n), np.int64)
            for width in np.unique(n):
                mine = n == width
                place[mine] = np.arange(mine.sum())
                some = v if mine.all() else v.filter(pa.array(mine))
                self.blocks[int(width)] = Block(ids.to_numpy()[mine], _matrix(some, int(width)), self.k)
            for p in np.unique(part):
                self.sent[int(p)] = place[of[part == p]]

    def compare(self, part: int, batch: pa.RecordBatch) -> None:
        if self.blocks is None:
            self._arrange()
        if part != self.part or self.held + len(batch) > ROWS_AT_ONCE:
            self.flush()
        self.part = part
        if part in self.sent:
            self.rows.append(batch)
            self.held += len(batch)

    def flush(self) -> None:
        if self.rows:
            got = pa.Table.from_batches(self.rows).combine_chunks()
            v = got["v"].combine_chunks()
            width = int(_lengths(v)[0])                      # a partition's vectors have one length
            self.blocks[width].add(self.sent[self.part], got["id"].to_numpy(), _matrix(v, width))
        self.rows, self.held = [], 0

    def nearest(self) -> Iterator[pa.RecordBatch]:
        self.flush()
        for block in (self.blocks or {}).values():
            yield from block.nearest()


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, parts: int | None = None, target: float = TARGET,
           sample: int = SAMPLE, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each query, by cosine in double precision.

    ``queries`` has the same columns; a row is no candidate for the query of
    its own id.  Vectors that are null, zero or hold a null or non-finite
    component take no part, nor do rows without an id.  Only vectors of the
    query's length are its candidates: the partitions are learned for the
    sample's commonest length, every other length is a partition of its own.
    With fewer candidates all are returned; of repeated ids every row is a
    candidate; empty tables give no rows; other columns are not read.

    The number of partitions grows with the table.  A query goes once to each
    cell of partitions that holds one of its own, and is compared there with
    the rows of its partitions only.  A cell's rows are dealt over blocks, and
    so are its queries, so that a task holds a bounded number of queries and
    sees a bounded number of rows, whatever share of the table equal vectors hold.
    """
    spark = prepare(vectors.sparkSession)
    kind = _kind(vectors, queries, vec_col)
    rows, asked = _usable(vectors, id_col, vec_col, kind), _usable(queries, id_col, vec_col, kind)
    nothing = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    total = rows.count()
    if not total:
        return nothing
    got = _sampled(vectors, id_col, vec_col, kind, sample, total)                      # bounded by the sample
    lengths = [len(v) for v in got]
    width = max(sorted(set(lengths)), key=lengths.count)
    wanted = parts or min(MOST, max(PARTITIONS, total // PART_ROWS))
    model = pickle.dumps(learn(np.array([v for v in got if len(v) == width], np.float64), wanted, target))

    n_cells = CELLS

    @F.arrow_udf("int")
    def home(v: pa.Array) -> pa.Array:
        return pa.array(_routed(v, width, _router(model), False))

    @F.arrow_udf("array<struct<cell:int,probes:array<int>>>")
    def cells(v: pa.Array) -> pa.Array:
        return _by_cell(_routed(v, width, _router(model), True), n_cells)

    placed = stored(rows.select("id", "v", home("v").alias("p")), "ann-rows").withColumn("cell", F.pmod("p", F.lit(n_cells)))
    sent = stored(asked.select("id", "v", cells("v").alias("at")), "ann-queries")
    bytes_of = F.size("v").cast("bigint") * (8 if kind == "float" else 12)             # the components and their unit
    tasks, start = [], 0                                                               # one row a cell
    for c in placed.groupBy("cell").agg(F.count("*").alias("n")).join(sent.select(
            F.explode("at.cell").alias("cell"), bytes_of.alias("size")).groupBy("cell").agg(
            F.count("*").alias("q"), F.sum("size").alias("size")), "cell").orderBy("cell").collect():
        rb, qb = -(-c.n // BLOCK), max(-(-c.q // QUERY_BLOCK), -(-c["size"] // QUERY_BYTES))
        tasks.append((c.cell, start, rb, qb))
        start += rb * qb
    if not tasks:                                                                      # no query has a candidate
        return nothing
    deal = F.broadcast(spark.createDataFrame(tasks, "cell int, start int, rb int, qb int"))
    one_of = lambda n: F.pmod(F.xxhash64("id", "v"), F.col(n)).cast("int")
    each_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    number = (F.col("start") + F.col("b") * F.col("qb") + F.col("c")).alias("t")
    # a row is in one block of its cell and meets each block of queries there
    rows_in = placed.join(deal, "cell").select("*", one_of("rb").alias("b"), each_of("qb").alias("c")).select(
        number, F.lit(True).alias("row"), "p", "id", "v", F.lit(None).cast("array<int>").alias("probes"))
    asked_in = sent.select("id", "v", F.explode("at").alias("a")).select("id", "v", "a.cell", "a.probes").join(deal, "cell").select(
        "*", each_of("rb").alias("b"), one_of("qb").alias("c")).select(
        number, F.lit(False).alias("row"), F.lit(None).cast("int").alias("p"), "id", "v", "probes")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, task = None, None
        for batch in batches:
            if not len(batch):
                continue
            t, row = batch.column("t").to_numpy(), batch.column("row").to_numpy(zero_copy_only=False)
            p = batch.column("p").fill_null(0).to_numpy()
            ends = np.r_[np.flatnonzero((t[1:] != t[:-1]) | (row[1:] != row[:-1]) | (p[1:] != p[:-1])) + 1, len(t)]
            lo = 0
            for hi in ends:
                if t[lo] != now:
                    if task is not None:
                        yield from task.nearest()
                    now, task = t[lo], Task(k)
                some = batch.slice(lo, hi - lo)
                if row[lo]:
                    task.compare(int(p[lo]), some.select(["id", "v"]))
                else:
                    task.ask(some.select(["id", "v", "probes"]))
                lo = hi
        if task is not None:
            yield from task.nearest()

    found = rows_in.unionByName(asked_in).repartitionById(start, "t").sortWithinPartitions("t", "row", "p").mapInArrow(
        compare, "query_id bigint, best array<struct<s:double,i:bigint>>")
    best = found.groupBy("query_id").agg(F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, k).alias("best"))   # k a task at most
    return best.select("query_id", F.posexplode("best").alias("r", "x")).select(
        "query_id", (F.col("r") + 1).cast("int").alias("rank"), F.col("x.i").alias("vec_id"), (-F.col("x.s")).alias("score"))

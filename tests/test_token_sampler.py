"""Token transitions and seeded paths over them."""

import datetime as dt
import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidecast.operators import token_sampler as ts

SCHEMA = "unique_id string, ds timestamp_ntz, token int"
DAY = dt.datetime(2024, 1, 1)


def table(spark, series):
    rows = [(i, DAY + dt.timedelta(days=k), t) for i, toks in series.items() for k, t in enumerate(toks)]
    return spark.createDataFrame(rows, SCHEMA)


def plain_counts(series):
    out = Counter()
    for toks in series.values():
        seen = [t for t in toks if t is not None]
        out.update(zip(seen, seen[1:]))
    return out


def plain_paths(series, h, samples, seed):
    follow = defaultdict(list)
    for (a, b), c in sorted(plain_counts(series).items()):
        follow[a] += [b] * c
    out = {}
    for i, toks in series.items():
        seen = [t for t in toks if t is not None]
        for s in range(1, samples + 1) if seen else ():
            t = seen[-1]
            for k in range(1, h + 1):
                key = ":".join(map(str, [seed] + ([] if i is None else [i]) + [s, k]))
                u = (int(hashlib.md5(key.encode()).hexdigest()[:8], 16) + 0.5) / 2 ** 32
                t = follow[t][int(u * len(follow[t]))] if follow[t] else t
                out[i, s, k] = (DAY + dt.timedelta(days=len(toks) - 1 + k), t)
    return out


def some_series(seed=0):
    rng = np.random.default_rng(seed)
    # one token stands for over a third of all rows, and many have one successor or none
    out = {f"s{k}": [int(t) if rng.random() > 0.1 else None for t in np.where(rng.random(n) < 0.4, 7, rng.integers(3, 60, n))]
           for k, n in enumerate([200, 90, 1, 2, 33])}
    return out | {None: [5, 7, 5, 7], "last only": [900], "without": [None, None], "ends unknown": [7, 901]}


@pytest.mark.parametrize("parts, salt", [(1, 1), (5, 8), (40, 3)])
def test_paths_equal_plain_draws_for_any_partitioning(spark, parts, salt):
    series = some_series()
    df = table(spark, series).repartition(parts)
    assert {(r.token, r.next): r.c for r in ts.token_transitions(df).collect()} == plain_counts(series)
    got = {(r.unique_id, r["sample"], r.step): (r.ds, r.token) for r in ts.sample_token_paths(df, 4, 6, 3, salt=salt).collect()}
    assert got == plain_paths(series, 4, 6, 3)
    assert all(got["last only", s, k][1] == 900 and got["ends unknown", s, k][1] == 901 for s in range(1, 7) for k in range(1, 5))


def test_other_transitions_and_their_shares(spark):
    counts = spark.createDataFrame([(3, 4, 1), (3, 5, 2), (3, 6, 97), (4, 3, 1), (5, 3, 1), (6, 3, 1)], "token int, next int, c long")
    df = table(spark, {"a": [1, 3]})
    got = ts.sample_token_paths(df, 2, 4000, 1, transitions=counts)
    share = {r.token: r.n / 4000 for r in got.where("step = 1").groupBy("token").agg(F.count("*").alias("n")).collect()}
    assert set(share) == {4, 5, 6} and abs(share[6] - 0.97) < 0.01 and abs(share[5] - 0.02) < 0.01
    assert {r.token for r in got.where("step = 2").collect()} == {3}


def test_odd_tables(spark):
    empty = table(spark, {"a": [3]}).where("false")
    assert ts.token_transitions(empty).count() == ts.sample_token_paths(empty, 3, 2).count() == 0
    only = table(spark, {"a": [None]})
    assert ts.sample_token_paths(only, 3, 2).count() == 0
    twice = table(spark, {"a": [3, 4, 5]})
    twice = twice.union(twice)                                # repeated rows count as often as they stand there
    assert {(r.token, r.next): r.c for r in ts.token_transitions(twice).collect()} == {
        (3, 3): 1, (3, 4): 1, (4, 4): 1, (4, 5): 1, (5, 5): 1}
    for bad in ({"h": 0}, {"num_samples": 0}, {"salt": 0}):
        with pytest.raises(ValueError):
            ts.sample_token_paths(twice, **({"h": 2, "num_samples": 2} | bad))

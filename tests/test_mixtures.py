"""Alias tables hold exactly the weights they were made of, and draws follow them."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidecast.operators import mixtures as mx
from tidecast.operators import sampling as sa


def weights(spark, rows):
    return spark.createDataFrame(rows, "dataset string, weight double")


def check_mass(rows, names):
    """Each dataset's parts of all buckets add up to its units; every bucket number stands there once."""
    assert {r.dataset for r in rows} == set(names)
    assert sorted(r.bucket for r in rows) == list(range(len(names)))
    mass = defaultdict(int)
    for r in rows:
        assert 0 <= r.keep <= r.full and r.parts == len(names)
        mass[r.dataset] += int(r.keep)
        mass[r.alias] += r.full - int(r.keep)
    assert {r.dataset: r.units * r.parts for r in rows} == dict(mass)


@pytest.mark.parametrize("rows", [
    [("a", 1.0)], [("a", 1.0), ("b", 1.0), ("c", 1.0)], [("a", 0.9), ("b", 0.1)],
    [("a", 1.0), ("b", 1e-15), ("c", 3.0), ("d", 3.0)],
    [(f"n{k}", 1.0 / (k + 1)) for k in range(200)],
    [(f"n{k}", 1000.0 if k == 77 else 1.0) for k in range(200)],
    [(f"n{k}", float(k % 7 + 1)) for k in range(331)]])
def test_table_holds_the_weights(spark, rows):
    check_mass(mx.alias_table(weights(spark, rows)).collect(), [n for n, _ in rows])


def test_odd_weights(spark):
    odd = weights(spark, [("a", 2.0), ("a", 1.0), (None, 5.0), ("b", None), ("c", 0.0), ("d", -1.0), ("e", float("nan")),
                          ("f", float("inf")), ("g", 1.0)])
    got = mx.alias_table(odd).collect()
    check_mass(got, ["a", "g"])
    assert {r.dataset: r.units for r in got} == {"a": mx.SCALE, "g": mx.SCALE // 3}
    assert mx.alias_table(odd.where("false")).count() == 0


def test_ten_thousand_datasets_in_one_plan(spark):
    df = spark.range(30_000).select(F.concat(F.lit("d"), (F.col("id") % 10_000).cast("string")).alias("dataset"),
                                    F.col("id").cast("string").alias("unique_id"))
    w = spark.range(10_000).select(F.concat(F.lit("d"), F.col("id").cast("string")).alias("dataset"),
                                   F.when(F.col("id") == 5, 20_000.0).otherwise(1.0).alias("weight"))
    got = mx.mixture_draws(df, w, 30_000, 3)
    rows = got.collect()
    assert len(rows) == 30_000 and all(int(r.unique_id) % 10_000 == int(r.dataset[1:]) for r in rows)
    share = sum(r.dataset == "d5" for r in rows) / len(rows)
    assert abs(share - 20_000 / 29_999) < 0.012
    assert len({r.unique_id for r in rows if r.dataset == "d5"}) == 3


def test_draws_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame([(d, f"{d}{k}") for d, n in (("a", 1), ("b", 7), ("c", 2)) for k in range(n)],
                               "dataset string, unique_id string")
    w = weights(spark, [("a", 5.0), ("b", 1.0), ("c", 2.0), ("no series", 9.0)])
    want = sorted(mx.mixture_draws(df, w, 500, 1).collect())
    assert sorted(mx.mixture_draws(df.union(df).repartition(23), w.repartition(5), 500, 1, salt=3).collect()) == want
    assert {r.dataset for r in want} == {"a", "b", "c"} and len(want) == 500


def test_all_alike_and_empty(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "3"), (None, "4")], "dataset string, unique_id string")
    got = sa.mixture_sample(df, None, 2000, 9).groupBy("dataset").count().collect()
    assert {r.dataset for r in got} == {"a", "b"} and all(abs(r["count"] - 1000) < 120 for r in got)
    assert mx.mixture_draws(df.where("false"), None, 10).count() == 0
    with pytest.raises(ValueError):
        mx.mixture_draws(df, None, 0)

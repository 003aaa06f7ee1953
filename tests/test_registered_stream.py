"""Streamed requests scored by the newest registered model."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from tidecast.session import scratch_path
from tidecast.streaming import registered as sr

REQ = "request_id string, request string"


def params(slope, intercept):
    return json.dumps({"slope": slope, "intercept": intercept, "n": 3, "context": None})


def registry(spark, rows):
    return spark.createDataFrame(rows, "name string, version string, params string")


def plain(values, h, b, a):
    v = [x for x in values if x is not None]
    s = sum(map(abs, v)) / len(v) or 1.0
    z, out = v[-1] / s, []
    for _ in range(h):
        z = a + b * z
        out.append(z * s)
    return out


def requests(spark, rows):
    return spark.createDataFrame(rows, REQ)


@pytest.mark.parametrize("b, a", [(0.5, 0.2), (1.0, 0.1), (-0.9, 0.0), (0.0, 0.0)])
def test_scores_equal_the_iterated_model(spark, b, a):
    rows = [("one", json.dumps({"inputs": [1.0, -2.0, 4.0]})), ("two", json.dumps({"inputs": [[3.0, None], [0.0, 0.0]]})),
            ("three", json.dumps({"dataframe_split": {"columns": ["timestamp", "value"], "index": [0, 1], "data": [
                ["2024-01-02 00:00:00", 8.0], ["2024-01-01 00:00:00", 2.0]]}, "params": {"h": 4}}))]
    reg = registry(spark, [("m", "9", params(7.0, 7.0)), ("m", "10", params(b, a)), ("m", "x", params(8.0, 8.0)),
                           ("other", "99", params(9.0, 9.0))])
    got = {r.request_id: r for r in sr.score_registered(requests(spark, rows), reg, "m").collect()}
    assert {r.version for r in got.values()} == {"10"} and all(r.error is None for r in got.values())
    assert got["one"].predictions[0] == pytest.approx(plain([1.0, -2.0, 4.0], 10, b, a))
    assert got["two"].predictions[0] == pytest.approx(plain([3.0], 10, b, a))
    assert got["two"].predictions[1] == pytest.approx(plain([0.0], 10, b, a))
    assert got["three"].predictions[0] == pytest.approx(plain([2.0, 8.0], 4, b, a))


def test_bad_requests_and_missing_versions_get_errors(spark):
    rows = [("ok", '{"inputs": [1.0]}'), ("bad", "{"), ("null", None), ("nothing", '{"inputs": [null]}')]
    good = registry(spark, [("m", "1", params(0.5, 0.0))])
    got = {r.request_id: (r.reply is not None, r.error) for r in sr.score_registered(requests(spark, rows), good, "m").collect()}
    assert got == {"ok": (True, None), "bad": (False, "malformed request"), "null": (False, "malformed request"),
                   "nothing": (False, "empty context")}
    for reg in (good.where("false"), registry(spark, [("m", "latest", params(0.5, 0.0))])):
        out = sr.score_registered(requests(spark, rows), reg, "m").collect()
        assert all(r.reply is None and r.error for r in out)
        assert {r.error for r in out if r.request_id == "ok"} == {"no registered version of m"}
    assert sr.score_registered(requests(spark, []), good, "m").count() == 0


def test_a_version_added_between_batches_shows_in_later_replies_only(spark):
    name = f"serving_{uuid.uuid4().hex[:10]}"
    in_dir, out, ck = (scratch_path(spark, k) for k in ("reg-in", "reg-out", "reg-ck"))

    def send(ids):
        requests(spark, [(i, '{"inputs": [1.0, 2.0]}') for i in ids]).coalesce(1).write.mode("append").json(in_dir)

    def run():
        q = sr.registered_stream(spark, in_dir, name, "m", out, ck, files_per_batch=1)
        q.awaitTermination()
        return {r.request_id: (r.version, r.reply) for r in sr.registered_replies(spark, out).collect()}

    registry(spark, [("m", "1", params(0.5, 0.0))]).write.saveAsTable(name)
    try:
        send(["a", "b"])
        first = run()
        assert {i: v for i, (v, _) in first.items()} == {"a": "1", "b": "1"}
        registry(spark, [("m", "2", params(0.25, 0.0))]).write.mode("append").saveAsTable(name)
        assert run() == first                                 # nothing new: nothing is scored again
        send(["c"])
        later = run()
        assert later["c"][0] == "2" and {i: later[i] for i in first} == first and len(later) == 3
        # the stream repeats a batch that was written whole: its replies stay as they are
        again = requests(spark, [("a", '{"inputs": [1.0, 2.0]}')])
        sr.write_batch(again, 0, name, "m", out)
        assert {r.request_id: (r.version, r.reply) for r in sr.registered_replies(spark, out).collect()} == later
        # a batch that was cut short (no mark of success) is written anew, and only once
        sr.score_registered(again, spark.table(name), "m").select(*sr.REPLY).write.option(
            "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{out}/batch_id=7")
        sr.write_batch(again, 7, name, "m", out)
        assert sr.registered_replies(spark, out).where(F.col("batch_id") == 7).count() == 1
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")

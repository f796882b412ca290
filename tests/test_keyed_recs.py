"""The keyed store against a dictionary that takes the same puts."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from pasarlens.sources import keyed_recs as K
from pasarlens.streaming.serving import answer_from_store, serve_stream
from pasarlens.operators.recommend import answer_requests

ITEM = "user_id string, recommendations array<long>, timestamp string"


def items(spark, rows):
    return spark.createDataFrame(rows, ITEM)


def stored(df):
    return {r["user_id"]: (r["recommendations"], r["timestamp"]) for r in df.collect()}


def folders(df):
    return {os.path.dirname(f) for f in df.inputFiles()}


def test_puts_and_compactions_as_a_dictionary(spark, tmp_path):
    path, rng, want = str(tmp_path / "store"), random.Random(3), {}
    for batch in range(5):
        rows = [(f"u{rng.randrange(40)}", [rng.randrange(99)], f"2024-01-{rng.randrange(1, 29):02d}") for _ in range(25)]
        rows = list({r[0]: r for r in rows}.values())  # one put per user and batch, so that ties lie between batches only
        K.put_keyed(items(spark, rows), path, batch, buckets=8)
        for user, recs, stamp in rows:
            if user not in want or stamp >= want[user][1]:
                want[user] = (recs, stamp)
        assert stored(K.read_keyed(spark, path)) == want
        if batch in (1, 3):
            assert K.compact(spark, path, 2) > 0 and K.compact(spark, path, 2) == 0
            assert stored(K.read_keyed(spark, path)) == want
    assert K.drop_replaced(spark, path) > 0
    assert stored(K.read_keyed(spark, path)) == want
    some = spark.createDataFrame([("u1",), ("u1",), ("u2",), ("nobody",), (None,)], "user_id string")
    assert stored(K.look_up(spark, path, some)) == {u: want[u] for u in ("u1", "u2") if u in want}


def test_last_put_of_a_batch_and_numeric_ids(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = spark.createDataFrame([(7, [1], "2024-01-01"), (7, [2], "2024-01-02"), (None, [3], "2024-01-01")], ITEM.replace("user_id string", "user_id long"))
    K.put_keyed(rows, path, 0, buckets=4)
    assert stored(K.look_up(spark, path, spark.createDataFrame([(7,), (None,)], "user_id long"))) == {"7": ([2], "2024-01-02")}
    assert stored(K.read_keyed(spark, path))[None] == ([3], "2024-01-01")


def test_opened_files_follow_the_asked_users(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = [(f"u{k}", [k], "2024-01-01") for k in range(400)]
    for batch in range(2):
        K.put_keyed(items(spark, rows), path, batch, buckets=16)

    def opened(n):
        users = spark.createDataFrame([(f"u{k}",) for k in range(n)], "user_id string")
        found = K.look_up(spark, path, users)
        assert found.count() == n
        buckets = users.select(K.bucket_of(F.col("user_id"), 16)).distinct().count()
        assert len(folders(found)) == 2 * buckets  # both runs of these buckets, nothing else
        return len(found.inputFiles())

    assert opened(1) == 2 < opened(3) < opened(400) == 32


def test_compaction_leaves_small_buckets_alone(spark, tmp_path):
    path = str(tmp_path / "store")
    K.put_keyed(items(spark, [(f"u{k}", [k], "2024-01-01") for k in range(60)]), path, 0, buckets=8)
    K.put_keyed(items(spark, [("u0", [-1], "2024-01-02")]), path, 1)
    before = folders(K.read_keyed(spark, path))
    assert K.compact(spark, path, 2) == 1
    after = folders(K.read_keyed(spark, path))
    assert len(before - after) == 2 and len(after - before) == 1  # two runs of one bucket became one
    assert stored(K.read_keyed(spark, path))["u0"] == ([-1], "2024-01-02") and len(stored(K.read_keyed(spark, path))) == 60


def test_repeated_stopped_and_late_batches(spark, tmp_path):
    path = str(tmp_path / "store")
    one, two = items(spark, [("a", [1], "2024-01-01")]), items(spark, [("a", [2], "2024-01-02"), ("b", [3], "2024-01-02")])
    with pytest.raises(ValueError):
        K.read_keyed(spark, path)
    K.put_keyed(one, path, 0, buckets=4)
    K.put_keyed(items(spark, []), path, 1)  # an empty batch leaves no trace
    two.withColumn("batch", F.lit(2)).withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(f"{path}/items/put-2")  # stopped before its manifest
    assert stored(K.read_keyed(spark, path)) == {"a": ([1], "2024-01-01")}
    for _ in range(2):
        K.put_keyed(two, path, 2)
    want = {"a": ([2], "2024-01-02"), "b": ([3], "2024-01-02")}
    assert stored(K.read_keyed(spark, path)) == want
    K.compact(spark, path, 2)
    K.put_keyed(two, path, 2)  # listed, so it is not written again
    with pytest.raises(ValueError):
        K.put_keyed(one, path, 1)  # never seen, and older than a compaction
    assert stored(K.read_keyed(spark, path)) == want


def test_requests_from_the_store_and_as_a_stream(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = [(str(k), [k, k + 1, k + 2], "2024-01-01") for k in range(50)]
    K.put_keyed(items(spark, rows), path, 0, buckets=8)
    asked = spark.createDataFrame([(1, '{"user_id": 7, "n": 2}'), (2, '{"user_id": "nobody"}'), (3, "{"), (4, '{"user_id": "007"}')], "request_id long, body string")
    want = {r["request_id"]: json.loads(r["response"]) for r in answer_requests(asked, items(spark, rows), "2024-02-01").collect()}
    got = {r["request_id"]: json.loads(r["response"]) for r in answer_from_store(asked, path, "2024-02-01").collect()}
    assert got == want and got[1]["recommendations"] == [7, 8]
    source = str(tmp_path / "in")
    asked.withColumn("requested_at", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).write.parquet(source)
    outs = [str(tmp_path / p) for p in ("answers", "served", "progress")]
    serve_stream(spark, source, path, *outs, "2024-02-01")
    assert {r["request_id"]: json.loads(r["response"]) for r in spark.read.parquet(outs[0]).collect()} == want

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pasarlens.operators import windows
from pasarlens.operators.skew import join_stats, with_group_stats
from tests.conftest import plan_of


@pytest.mark.parametrize("hot_rows", [None, 10])
def test_group_stats_equal_a_window(spark, hot_rows):
    rows = [(i, None if i % 5 == 0 else "hot" if i % 2 else f"u{i % 40}", float(i % 7)) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, u string, v double")
    w = Window.partitionBy("u")
    df = df.withColumn("want_n", F.count("*").over(w)).withColumn("want_s", F.sum("v").over(w))
    got = with_group_stats(df, ["u"], {"n": F.count("*"), "s": F.sum("v")}, ["id"], True, hot_rows)
    assert got.count() == 400
    assert got.where("n <> want_n or s <> want_s or n is null").count() == 0
    assert ("explode" in plan_of(got)) == (hot_rows == 10)


def test_rows_without_key_are_kept_and_spread(spark):
    df = spark.createDataFrame([(i, None if i % 2 else i % 3) for i in range(60)], "id long, k int")
    stats = spark.createDataFrame([(0, 10, "a"), (1, 10, "b")], "k int, n long, name string")
    got = join_stats(df, stats, ["k"], "n", ["id"], null_keys=True)
    assert got.count() == 60 and got.where("k is null and name is null").count() == 30
    assert got.where("k = 0 and name <> 'a' or k = 2 and name is not null").count() == 0


@pytest.mark.parametrize("hot_rows", [None, 5])
def test_velocity_border(spark, hot_rows):
    rows = [(i, 1, f"2024-01-01 00:{i:02d}:00", 10.0) for i in range(11)]
    rows += [(100 + i, 2, f"2024-01-01 00:{i:02d}:00", 10.0) for i in range(10)]
    df = spark.createDataFrame(rows, "transaction_id long, user_id long, timestamp string, total_idr double")
    df = df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    for job in (windows.velocity, windows.velocity_and_rfm):
        got = {(r["user_id"], r["user_txn_per_day"], r["is_high_velocity"]) for r in job(df, hot_rows).collect()}
        assert got == {(1, 11, 1), (2, 10, 0)}
    rfm = {(r["user_id"], r["user_total_spend"], r["user_avg_order"]) for r in windows.velocity_and_rfm(df, hot_rows).collect()}
    assert rfm == {(1, 110.0, 10.0), (2, 100.0, 10.0)}


def test_hot_unknown_user_and_missing_product_are_spread(spark, monkeypatch):
    """Sizes come from the rows, so a key that the other side lacks is found hot as well."""
    from pasarlens.operators import skew
    from pasarlens.operators.joins import enrich
    from pasarlens.operators.recommend import answer_requests

    found = []
    plain = skew.join_stats

    def seen(rows, stats, keys, size, *args, **more):
        found.append({r[keys[0]]: r[size] for r in stats.collect()})
        return plain(rows, stats, keys, size, *args, **more)

    monkeypatch.setattr("pasarlens.operators.recommend.join_stats", seen)
    monkeypatch.setattr("pasarlens.operators.joins.join_stats", seen)
    asked = spark.createDataFrame([(i, '{"user_id": "bot"}') for i in range(40)], "request_id long, body string")
    lists = spark.createDataFrame([("a", [1])], "user_id string, recommendations array<long>")
    assert answer_requests(asked, lists, "2024-02-01").where("status = 200").count() == 40
    recs = spark.createDataFrame([(i, 77) for i in range(30)], "user_id long, product_id long")
    goods = spark.createDataFrame([(1, "n", "c", 1.0)], "product_id long, product_name string, category string, final_price_idr double")
    assert enrich(recs, goods).where("product_name is null").count() == 30
    assert found == [{"bot": 40}, {77: 30}]

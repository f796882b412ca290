import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pasarlens.operators import ranking
from pasarlens.operators.windows import spend_tier
from tests.conftest import plan_of


def table(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, v double")


def expected_tiles(df, tiles):
    return df.withColumn("want", F.ntile(tiles).over(Window.orderBy("v", "id")))


def mixed(n, seed):
    chance = random.Random(seed)
    # a third of all rows share one value, some are null
    return [5.0 if i % 3 == 0 else None if i % 17 == 0 else chance.choice([chance.random() * 9, float(i % 4)]) for i in range(n)]


@pytest.mark.parametrize("tiles", [4, 20])
@pytest.mark.parametrize("n", [1, 3, 19, 403])
def test_global_ntile_equals_window(spark, n, tiles):
    df = table(spark, mixed(n, n))
    got = ranking.global_ntile(expected_tiles(df, tiles), tiles, "v", "id", "got", measured=df)
    assert got.where("got <> want").count() == 0


def test_global_ntile_many_rounds(spark, monkeypatch):
    monkeypatch.setattr(ranking, "FINISH_ROWS", 0)
    monkeypatch.setattr(ranking, "ACCURACY", 50)
    df = table(spark, mixed(3000, 1))
    got = ranking.global_ntile(expected_tiles(df, 20), 20, "v", "id", "got", measured=df)
    assert got.where("got <> want").count() == 0


def test_all_equal_values(spark):
    df = table(spark, [1.0] * 100)
    got = ranking.global_ntile(df, 20, "v", "id", "got").groupBy("got").count().collect()
    assert {r["count"] for r in got} == {5} and len(got) == 20


def test_no_single_task_sort_in_spend_tier(spark):
    df = spark.createDataFrame([(i, float(i % 7)) for i in range(50)], "user_id long, total_spend_idr double")
    plan = plan_of(spend_tier(df))
    assert "Window" not in plan and "SinglePartition" not in plan


@pytest.mark.parametrize("limit", [None, 0])
def test_rank_and_tile_in_groups(spark, limit):
    chance = random.Random(3)
    rows = [(i, "hot" if i % 2 else f"g{i % 9}" if i % 10 else None, chance.randint(0, 5)) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, g string, v int")
    w = Window.partitionBy("g").orderBy("v", "id")
    df = df.withColumn("want_rank", F.row_number().over(w)).withColumn("want_tile", F.ntile(5).over(w))
    got = ranking.rank_in_group(df, ["g"], ["v"], "id", "rank", limit)
    got = ranking.ntile_in_group(got, 5, ["g"], ["v"], "id", "tile", limit)
    assert got.count() == 500
    assert got.where("rank <> want_rank or tile <> want_tile or rank is null or tile is null").count() == 0


def test_position_of_text_ids(spark):
    names = [f"name-{i * 7919 % 1000:04d}" for i in range(1000)]
    df = spark.createDataFrame([(n,) for n in names], "name string").repartition(7)
    got = ranking.global_position(df, ["name"]).collect()
    assert [r["name"] for r in sorted(got, key=lambda r: r["position"])] == sorted(names)
    assert sorted(r["position"] for r in got) == list(range(1000))


def test_running_total(spark):
    df = spark.createDataFrame([(i, i % 5) for i in range(300)], "k long, n long").repartition(5)
    got = {r["k"]: r["cum_n"] for r in ranking.running_total(df, "k", ["n"]).collect()}
    total = 0
    for i in range(300):
        total += i % 5
        assert got[i] == total


def test_key_must_be_unique(spark):
    df = spark.createDataFrame([(1, 2.0)] * 10, "id long, v double")
    with pytest.raises(ValueError):
        ranking.global_ntile(df, 4, "v", "id", "t")


@pytest.mark.parametrize("limit", [None, 0])
def test_row_without_a_key_is_ranked_on_both_paths(spark, limit):
    rows = [(1, "g", 3), (2, "g", 1), (None, "g", 2), (4, "h", 1)]
    df = spark.createDataFrame(rows, "id long, g string, v int")
    got = ranking.rank_in_group(df, ["g"], ["v"], "id", "place", window_rows=limit)
    assert {(r["id"], r["place"]) for r in got.collect()} == {(2, 1), (None, 2), (1, 3), (4, 1)}


def test_digests_are_not_merged_by_one_task(spark, monkeypatch):
    monkeypatch.setattr(ranking, "DIGEST_GROUPS", 3)
    monkeypatch.setattr(ranking, "FINISH_ROWS", 0)
    df = table(spark, mixed(2000, 9)).repartition(8)
    got = ranking.global_ntile(expected_tiles(df, 20), 20, "v", "id", "got", measured=df)
    assert got.where("got <> want").count() == 0

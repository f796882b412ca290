from pyspark.sql import functions as F

from pasarlens.operators import clean
from tests.conftest import plan_of


def test_dedup_keeps_first_by_order_and_one_null_key(spark):
    rows = [(1, "b"), (1, "a"), (None, "z"), (None, "y"), (2, None), (2, "c")]
    got = clean.dedup(spark.createDataFrame(rows, "k int, v string"), ["k"]).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, "a"), (None, "y"), (2, None)], key=str)


def test_order_of_dedup_and_null_drop(spark):
    df = spark.createDataFrame([(2, None), (2, "c"), (3, "d")], "k int, v string")
    assert [tuple(r) for r in clean.basic_clean(df, ["k"], ["v"]).collect()] == [(3, "d")]
    got = clean.basic_clean(df, ["k"], ["v"], nulls_first=True).orderBy("k").collect()
    assert [tuple(r) for r in got] == [(2, "c"), (3, "d")]


def test_dedup_limits_copies_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    assert "WindowGroupLimit" in plan_of(clean.dedup(df, ["k"]))


def test_casts_turn_bad_text_into_null(spark):
    df = spark.createDataFrame([("7", "1.5"), ("12.9", "x"), ("abc", None)], "a string, b string")
    got = [tuple(r) for r in clean.cast_columns(df, {"a": "int", "b": "double"}).collect()]
    assert got == [(7, 1.5), (12, None), (None, None)]


def test_observed_counts(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "k int, v string")
    cleaned, before, after = clean.observed_clean(df, ["k"], ["v"])
    assert cleaned.count() == 1
    assert before.get["rows"] == 3 and after.get["rows"] == 1


def test_filters(spark):
    df = spark.createDataFrame([(0,), (1,), (5,), (6,), (None,)], "r int")
    assert [r[0] for r in clean.between(df, "r", 1, 5).collect()] == [1, 5]
    assert [r[0] for r in clean.positive(df, "r").collect()] == [1, 5, 6]


def test_staged_dedup_moves_only_rows_with_copies(spark):
    single = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], "k int, v string")
    assert "Exchange" not in plan_of(clean.staged_dedup(single, ["k"], "single"))
    rows = [(1, "b"), (1, "a"), (None, "z"), (None, "y"), (2, None), (2, "c"), (3, "d"), (4, None)]
    df = spark.createDataFrame(rows, "k int, v string")
    want = sorted(map(tuple, clean.dedup(df, ["k"]).collect()), key=str)
    for most in (None, 0):
        got = clean.staged_dedup(df, ["k"], "copies", most=most)
        assert sorted(map(tuple, got.collect()), key=str) == want and got.columns == df.columns


def test_staged_dedup_by_two_keys_and_an_order(spark):
    rows = [(1, 1, 5, "a"), (1, 1, 4, "b"), (1, 2, 3, "c"), (1, None, 2, "d"), (1, None, 1, "e"), (None, None, 0, "f")]
    df = spark.createDataFrame(rows, "a int, b int, o int, v string")
    got = clean.staged_dedup(df, ["a", "b"], "two", ["o"])
    assert sorted(r["v"] for r in got.collect()) == ["b", "c", "e", "f"]

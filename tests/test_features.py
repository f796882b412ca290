from pyspark.sql import functions as F

from pasarlens.functions import features as X


def values(spark, kind, items, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, x {kind}")
    return [r[0] for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").select("y").collect()]


def test_age_and_recency_borders(spark):
    assert values(spark, "int", [24, 25, 34, 35, 44, 45, None], X.age_group) == [
        "Gen-Z", "Millennial", "Millennial", "Gen-X", "Gen-X", "Boomer", "Boomer"
    ]
    assert values(spark, "int", [30, 31, 90, 91, 180, 181, None], X.recency_bucket) == [
        "active", "warm", "warm", "cooling", "cooling", "churned", "churned"
    ]


def test_click_position(spark):
    assert values(spark, "int", [-1, 0, 3, 4, 10, 11, None], X.click_position_bucket) == [
        "no_click", "top3", "top3", "top10", "top10", "below10", "below10"
    ]


def test_sentiment_and_rating_rounding(spark):
    assert values(spark, "int", [1, 2, 3, 4, 5], X.sentiment) == [
        "negative", "negative", "neutral", "positive", "positive"
    ]
    assert values(spark, "double", [0.2, 1.5, 2.5, 4.5, 7.0], X.clip_round_rating) == [1.0, 2.0, 2.0, 4.0, 5.0]


def test_score_given_mapped_unknown(spark):
    rows = [(9, "view"), (None, "purchase"), (None, "signup"), (None, None)]
    df = spark.createDataFrame(rows, "s int, t string")
    got = [r[0] for r in df.select(X.implicit_score(F.col("s"), F.col("t"))).collect()]
    assert got == [9, 7, None, None]


def test_text_shape(spark):
    df = spark.createDataFrame([(0, ""), (1, "a"), (2, "\tgood  one!?"), (3, "a b c d e")], "i int, t string")
    got = df.withColumns(X.text_shape("t")).orderBy("i").select("char_count", "word_count", "has_exclamation", "has_question").collect()
    assert [tuple(r) for r in got] == [(0, 1, 0, 0), (1, 1, 0, 0), (12, 3, 1, 1), (9, 5, 0, 0)]


def test_bad_text_and_zero_price_give_null(spark):
    assert values(spark, "string", ["2024-01-02 03:04:05", "2024-13-02 03:04:05", "2024-1-2 03:04:05", "x", None], X.parse_timestamp)[1:] == [None] * 4
    df = spark.createDataFrame([(5.0, 0.0), (5.0, 20.0)], "d double, p double")
    got = [r[0] for r in df.select(X.effective_discount_pct(F.col("d"), F.col("p"))).collect()]
    assert got == [None, 25.0]


def test_flags(spark):
    df = spark.createDataFrame([(0, None, None, None), (None, "c", 1.0, None), (3, None, None, 2.0)], "n int, c string, lo double, hi double")
    flags = X.filter_flags(F.col("c"), F.col("lo"), F.col("hi"))
    got = [tuple(r) for r in df.select(X.is_zero_result(F.col("n")), *flags.values()).collect()]
    assert got == [(1, 0, 0), (None, 1, 1), (0, 0, 1)]


def test_odd_hour_and_fraud_score(spark):
    df = spark.createDataFrame([("2024-01-01 04:59:59",), ("2024-01-01 05:00:00",), (None,)], "t string")
    odd = X.is_odd_hour(X.parse_timestamp(F.col("t")))
    got = [r[0] for r in df.select(X.fraud_score(odd, F.lit(1), F.lit(1))).collect()]
    assert got == [3, 2, None]

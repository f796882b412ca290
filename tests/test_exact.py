import math

from pyspark.sql import functions as F

from pasarlens.functions.exact import money, money_sum


def sums(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    return df.agg(money_sum("x").alias("s")).first()["s"]


def test_odd_amounts_show_in_the_sum(spark):
    assert sums(spark, [0.1] * 10 + [None]) == 1.0
    assert math.isnan(sums(spark, [1.0, float("nan"), 2.0]))
    assert sums(spark, [1.0, float("inf")]) == math.inf
    assert sums(spark, [1e15, 0.25]) == 1e15 + 0.25
    assert sums(spark, [1e40, 1.0]) == 1e40
    assert sums(spark, []) is None and sums(spark, [None]) is None


def test_sum_does_not_depend_on_the_order(spark):
    values = [0.1 * k for k in range(1, 2000)]
    assert sums(spark, values) == sums(spark, values[::-1])
    assert spark.range(1).select(money(F.lit(float("nan"))).alias("m")).first()["m"] is None

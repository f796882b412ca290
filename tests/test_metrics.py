import itertools
import math
import random

from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator

from pasarlens.operators import metrics as E


def auc(spark, rows):
    return E.roc_auc(spark.createDataFrame(rows, "label int, score double")).first()["auc"]


def test_auc_against_all_pairs(spark):
    chance = random.Random(5)
    rows = [(chance.randint(0, 1), float(chance.randint(0, 9))) for _ in range(200)]
    pos = [s for y, s in rows if y]
    neg = [s for y, s in rows if not y]
    wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    assert math.isclose(auc(spark, rows), wins / len(pos) / len(neg))


def test_auc_ties_and_one_class(spark):
    assert auc(spark, [(0, 1.0), (1, 1.0), (0, 1.0)]) == 0.5
    assert auc(spark, [(1, 1.0), (1, 2.0)]) is None


def test_reports_against_spark_evaluators(spark):
    chance = random.Random(6)
    rows = [(float(chance.randint(0, 2)), float(chance.randint(0, 2)), chance.random()) for _ in range(300)]
    df = spark.createDataFrame(rows, "label double, prediction double, score double")
    got = E.accuracy_f1(df).first()
    for name, value in (("accuracy", got["accuracy"]), ("f1", got["f1_weighted"])):
        assert math.isclose(MulticlassClassificationEvaluator(metricName=name).evaluate(df), value)
    binary = df.where("label < 2")
    want = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(binary)
    assert math.isclose(E.roc_auc(binary).first()["auc"], want)


def test_regression(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (4.0, 3.0)], "label double, prediction double")
    got = E.regression_metrics(df).first()
    assert math.isclose(got["rmse"], math.sqrt(1.25 / 3)) and math.isclose(got["mae"], 0.5)
    mean = 7 / 3
    assert math.isclose(got["r2"], 1 - 1.25 / sum((y - mean) ** 2 for y in (1, 2, 4)))


def test_ndcg_borders(spark):
    schema = "id long, query_id int, relevance int, score double"
    ideal = spark.createDataFrame([(i, 1, r, float(r)) for i, r in enumerate([3, 2, 1, 0])], schema)
    assert {r["ndcg"] for r in E.ndcg_at_k(ideal).collect()} == {1.0}
    nothing = spark.createDataFrame([(1, 1, 0, 0.5), (2, 1, 0, 0.4)], schema)
    assert {r["ndcg"] for r in E.ndcg_at_k(nothing).collect()} == {1.0}
    turned = spark.createDataFrame([(1, 1, 0, 0.9), (2, 1, 3, 0.1)], schema)
    assert math.isclose(E.ndcg_at_k(turned, (5,)).first()["ndcg"], 1 / math.log2(3))

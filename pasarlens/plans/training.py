"""Training jobs: the recommender, and all prediction tasks with their registry."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pasarlens.models import neural, ranker, recommender, tasks
from pasarlens.models.tasks import Result
from pasarlens.operators.aggregates import matrix_stats
from pasarlens.operators import prep
from pasarlens.plans.jobs import at_once
from pasarlens.sources.model_store import load_model, model_registry, save_model, saved_models, write_registry
from pasarlens.session import stage
from pasarlens.sources.sinks import write_matrix

# Registry lines - task, model family, metric shown.
REGISTRY = {
    "churn-prediction": ("Churn Prediction", "Boosted trees, adaptive search", "auc"),
    "user-segmentation": ("User Segmentation", "Softmax boosted trees", "f1_weighted"),
    "ltv-prediction": ("LTV Prediction", "Boosted regression trees, adaptive search", "r2"),
    "fraud-detection": ("Fraud Detection", "Boosted trees + SMOTE", "auc"),
    "review-sentiment": ("Sentiment Analysis", "Softmax boosted trees + TF-IDF", "f1_weighted"),
    "review-rating": ("Rating Prediction", "Boosted regression trees + TF-IDF", "r2"),
    "product-trending": ("Trending Detection", "Boosted trees", "auc"),
    "product-click-through-rate": ("CTR Prediction", "Boosted regression trees", "r2"),
    "product-conversion-rate": ("CVR Prediction", "Boosted regression trees", "r2"),
    "search-ctr": ("Search CTR", "Boosted trees", "auc"),
    "collaborative-filtering": ("Collaborative Filter", "Neural factors (GMF + MLP)", "mse"),
    "search-ranking": ("Search Ranking", "Boosted trees on NDCG", "ndcg@10"),
}
METRIC_NAMES = {"auc": "AUC", "f1_weighted": "F1", "r2": "R2", "mse": "MSE", "ndcg@10": "NDCG@10"}


@dataclass(frozen=True)
class Plan:
    """Sizes that several tasks share; the tasks' own budgets are the defaults of ``models.tasks``."""

    max_features: int = 3000
    min_df: int = 5
    shape: neural.Shape = neural.Shape()


def train_recommender(
    spark: SparkSession, tables: Sequence[DataFrame], root: str, saved_at: str, **params
) -> DataFrame:
    """Fit the count model, save it with its matrix and dictionaries, and describe it."""
    fitted = recommender.train_recommender(*tables, **params)
    path = save_model(spark, fitted.model, "recommender", {}, root, saved_at, recommender.COUNT_MODEL)
    write_matrix(fitted.matrix, f"{path}_matrix")
    fitted.user_ids.write.mode("overwrite").parquet(f"{path}_users")
    fitted.product_ids.write.mode("overwrite").parquet(f"{path}_products")
    return matrix_stats(fitted.matrix.select("user_id", "product_id"))


CURVE = "epoch int, train_mse double, val_mse double, rate double"


def collaborative_filter(interactions: DataFrame, plan: Plan = Plan()) -> tuple[Result, DataFrame]:
    """Scores of users and products by neural factors, and the losses by epoch."""
    spark = interactions.sparkSession

    def make(work: str) -> Result:
        train, test = recommender.scored_rows(interactions)
        model = neural.fit_neural(train, test, f"{work}/epochs", plan.shape)
        predictions = stage(model.transform(test), "scored")
        mean = train.agg(F.avg("score_norm")).first()[0]
        guess = neural.squared_error(test.withColumn("prediction", F.lit(mean)))
        return Result("collaborative-filtering", model, predictions, {"mse": neural.squared_error(predictions)}, guess={"mse": guess})

    result = tasks.kept("collaborative-filtering", [interactions], plan, make)
    return result, spark.createDataFrame(result.model.history, CURVE)


def save_result(spark: SparkSession, result: Result, root: str, saved_at: str) -> str:
    """The model with its metrics, best parameters, and all that preparing new rows needs."""
    notes = {"features": result.features, "best_parameters": result.best}
    recipe = result.recipe
    if recipe:
        notes |= {"key": recipe.key, "numbers": recipe.numbers, "texts": recipe.texts, "tables": list(recipe.tables)}
    tables = recipe.tables if recipe else {}
    metrics = {**result.metrics, "test_rows": result.predictions.count()}
    return save_model(spark, result.model, result.name, metrics, root, saved_at, notes, tables)


def score_new(spark: SparkSession, root: str, path: str, rows: DataFrame) -> DataFrame:
    """Predictions of a saved model for new raw rows: the key, ``prediction`` and, of classes, ``score``.

    The rows are prepared with the saved dictionaries and vocabulary; a category the training has
    not seen has a code of its own (-1), and rows that lack a value are left out.
    """
    record = saved_models(spark, root).where(F.col("path") == path).first()
    notes = {k: json.loads(v) for k, v in record["notes"].items()}
    tables = {t: spark.read.parquet(f"{path}_{t}") for t in notes["tables"]}
    features, names = tasks.Recipe(notes["key"], notes["numbers"], notes["texts"], tables).apply(rows)
    found = tasks.scored(load_model(spark, path), prep.assemble(features, names))
    return found.select(notes["key"], *[c for c in ("prediction", "score") if c in found.columns])


def key_metric(result: Result) -> str:
    metric = REGISTRY[result.name][2]
    value = result.metrics.get(metric)
    return f"{METRIC_NAMES[metric]} = {value:.4f}" if value is not None else f"{METRIC_NAMES[metric]} = n/a"


def train_all(
    spark: SparkSession,
    users: DataFrame,
    transactions: DataFrame,
    reviews: DataFrame,
    products: DataFrame,
    searches: DataFrame,
    interactions: DataFrame,
    root: str,
    saved_at: str,
    plan: Plan = Plan(),
) -> DataFrame:
    """Train, save and register every task; returns the registry (one line per task).

    The tasks run at the same time.  Each keeps its result (see ``tasks.kept``), so a run that was
    stopped goes on with the tasks, and within a search with the trials, that it has not finished.
    """
    texts = tasks.review_rows(reviews, plan.max_features, plan.min_df)
    goods = tasks.product_rows(products)
    jobs = {
        "churn-prediction": lambda: tasks.churn(users),
        "user-segmentation": lambda: tasks.segmentation(users),
        "ltv-prediction": lambda: tasks.ltv(users),
        "fraud-detection": lambda: tasks.fraud(transactions),
        "review-sentiment": lambda: tasks.sentiment(texts),
        "review-rating": lambda: tasks.rating(texts),
        "product-trending": lambda: tasks.trending(goods),
        "product-click-through-rate": lambda: tasks.product_rate(goods, "click_through_rate"),
        "product-conversion-rate": lambda: tasks.product_rate(goods, "conversion_rate"),
        "search-ctr": lambda: tasks.search_ctr(searches),
        "collaborative-filtering": lambda: collaborative_filter(interactions, plan)[0],
        "search-ranking": lambda: ranker.search_rank(searches),
    }
    results = at_once(spark, jobs)
    paths = at_once(spark, {name: lambda r=r: save_result(spark, r, root, saved_at) for name, r in results.items()})
    lines = [
        {"task": REGISTRY[name][0], "model": REGISTRY[name][1], "key_metric": key_metric(result), "path": paths[name]}
        for name, result in results.items()
    ]
    registry = model_registry(spark, lines)
    write_registry(registry, f"{root}/model_registry")
    return registry

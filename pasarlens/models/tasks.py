"""The prediction tasks: columns, preparation, model and evaluation of each."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Model
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pasarlens.functions import features as X
from pasarlens.models import boosting, tuning
from pasarlens.models.boosting import Booster, Params
from pasarlens.models.objectives import Logistic, Objective, Softmax, Squared
from pasarlens.models.tuning import CHURN_SPACE, LTV_SPACE, Trial, TrialLog
from pasarlens.operators import metrics as E
from pasarlens.operators import prep
from pasarlens.plans.jobs import finished, work_path
from pasarlens.session import stage
from pasarlens.sources.model_store import load_model

SEED = 42
TEST_SHARE = 0.2

# --- Fixed values: the columns of the tasks ---------------------------------------------

USER_NUMBERS = (
    "age",
    "tenure_days",
    "loyalty_score",
    "total_spend_idr",
    "avg_order_value_idr",
    "total_orders",
    "total_items_purchased",
    "days_since_last_purchase",
    "email_open_rate",
    "push_notif_enabled",
    "is_premium_member",
    "referral_count",
    "avg_session_duration_sec",
    "avg_pages_per_session",
)
USER_TEXTS = ("gender", "city", "preferred_device", "acquisition_channel")
FRAUD_NUMBERS = (
    "quantity",
    "unit_price_idr",
    "discount_amt_idr",
    "shipping_fee_idr",
    "subtotal_idr",
    "total_idr",
    "hour_of_day",
    "day_of_week",
    "is_weekend",
    "delivery_days",
)
FRAUD_TEXTS = ("payment_method", "payment_status", "platform")
REVIEW_NUMBERS = ("helpful_votes", "verified_purchase", "has_photo")
PRODUCT_NUMBERS = (
    "base_price_idr",
    "discount_pct",
    "final_price_idr",
    "weight_gram",
    "is_digital",
    "is_imported",
    "stock_quantity",
    "avg_rating",
    "review_count",
    "views_last_30d",
    "sales_last_30d",
    "days_since_listed",
)
PRODUCT_TEXTS = ("category", "subcategory", "brand")
SEARCH_NUMBERS = (
    "query_length",
    "n_results",
    "hour_of_day",
    "day_of_week",
    "is_weekend",
    "response_time_ms",
)
SEARCH_TEXTS = ("sort_by", "platform", "filter_category")


# Boosting stops when this share of the training rows, held back by a hash of the key, gains no more.
VALIDATION_SHARE = 0.1
VALIDATION = "is_validation"


@dataclass(frozen=True)
class Budget:
    """How long to train at most, and the size of the parameter search."""

    params: Params = Params()
    trials: int = 30
    folds: int = 3


# The boosting parameters of the tasks.
SEGMENT_PARAMS = Params(rounds=500, depth=6, leaves=64, step=0.05, rows=0.8, columns=0.8, min_weight=1.0)
FRAUD_PARAMS = Params(rounds=600, depth=7, leaves=128, step=0.05, rows=0.8, columns=0.8, min_weight=1.0)
REVIEW_PARAMS = Params(rounds=400, depth=6, leaves=63, step=0.05, l2=0.0, min_rows=20)
PRODUCT_PARAMS = Params(rounds=400, depth=6, leaves=63, step=0.05, l2=0.0, min_rows=20)
SEARCH_PARAMS = Params(rounds=500, depth=7, leaves=127, step=0.05, l2=0.0, min_rows=20)
TUNED_PARAMS = Params(depth=6, leaves=1024, patience=25)


@dataclass
class Result:
    """A fitted task: model, scored test rows, metrics and the feature names."""

    name: str
    model: Model
    predictions: DataFrame
    metrics: dict[str, float]
    features: list[str] = field(default_factory=list)
    recipe: Recipe | None = None
    best: dict[str, float] = field(default_factory=dict)  # parameters a search has chosen
    trials: list[Trial] = field(default_factory=list)
    guess: dict[str, float] = field(default_factory=dict)  # the same metrics of the best constant, from the training rows


@dataclass
class Recipe:
    """How raw rows become features: what has to be saved next to the model."""

    key: str
    numbers: list[str]
    texts: list[str]
    tables: dict[str, DataFrame] = field(default_factory=dict)  # dictionaries and vocabulary

    def apply(self, df: DataFrame) -> tuple[DataFrame, list[str]]:
        """Feature columns of new rows; rows that lack a value are left out, as in training."""
        if "vocabulary" in self.tables:
            kept = df.dropna(subset=["review_text"]).fillna(0, subset=self.numbers)
            chosen = stage(kept.select(self.key, "review_text", *self.numbers), "new-rows")
            documents = prep.tokenized(chosen, self.key, "review_text")
            vectors = prep.text_vectors(chosen.drop("review_text"), self.key, "review_text", self.tables["vocabulary"], documents)
            return vectors, [*self.numbers, "text_vector"]
        rows = df.select(self.key, *self.numbers, *self.texts).dropna()
        if self.texts:
            rows = prep.encode_categories(rows, self.texts, [self.key], dictionary=self.tables["categories"])
        names = [*self.numbers, *[code(t) for t in self.texts]]
        return rows.select(self.key, *[F.col(c).cast("double").alias(c) for c in names]), names


@dataclass
class Prepared:
    """Complete rows with numeric features, their names, and the recipe that made them."""

    rows: DataFrame
    names: list[str]
    recipe: Recipe


def code(column: str) -> str:
    return f"{column}_code"


def prepared(
    df: DataFrame, key: str, numbers: Sequence[str], texts: Sequence[str], labels: Sequence[str]
) -> Prepared:
    """Needed columns, complete rows, text columns as codes; written once for training."""
    rows = df.select(key, *numbers, *texts, *labels).dropna()
    recipe = Recipe(key, list(numbers), list(texts))
    if texts:
        rows = stage(rows, "complete")
        recipe.tables["categories"] = stage(prep.category_codes(rows, texts), "categories")
        rows = prep.encode_categories(rows, texts, [key], dictionary=recipe.tables["categories"])
    names = [*numbers, *[code(t) for t in texts]]
    kept = rows.select(key, *[F.col(c).cast("double").alias(c) for c in names], *labels)
    return Prepared(stage(kept, "prepared"), names, recipe)


def split(
    df: DataFrame, key: str, label: str | None, share: float = TEST_SHARE
) -> tuple[DataFrame, DataFrame]:
    return prep.parts(prep.stratified_split(df, key, label, share, SEED))


def held_back(train: DataFrame, key: str) -> DataFrame:
    """Mark the rows that tell boosting when to stop; made-up rows (without a key) never do."""
    share = prep.shuffle_share(F.col(key), SEED + 1)
    return train.withColumn(VALIDATION, F.col(key).isNotNull() & (share < VALIDATION_SHARE))


def fit_boosted(
    train: DataFrame, test: DataFrame, label: str, objective: Objective, params: Params, names: Sequence[str], weight: str | None = None
) -> tuple[Booster, DataFrame]:
    """Boost the training rows (with the mark of the rows held back) and score the test rows."""
    model = boosting.fit(prep.assemble(train, names), label, objective, params, weight, VALIDATION, names=names)
    return model, scored(model, prep.assemble(test, names))


def scored(model: Model, assembled: DataFrame) -> DataFrame:
    found = model.transform(assembled)
    if "probability" in found.columns:
        chances = vector_to_array("probability")
        found = found.withColumn("score", F.get(chances, F.lit(1)))
    heavy = ("features", "rawPrediction", "probability", "text_vector", "terms")
    return stage(found.drop(*heavy), "scored")


def classifier_metrics(predictions: DataFrame, label: str, binary: bool) -> dict[str, float]:
    found = E.accuracy_f1(predictions, label).first().asDict()
    if binary:
        found["auc"] = E.roc_auc(predictions, label).first()["auc"]
    return found


def regressor_metrics(predictions: DataFrame, label: str, prediction: str = "prediction") -> dict[str, float]:
    return E.regression_metrics(predictions, label, prediction).first().asDict()


def guess_class(train: DataFrame, test: DataFrame, label: str) -> dict[str, float]:
    """Metrics of the most frequent class of the training rows on the test rows."""
    top = train.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), label).first()[0]
    found = E.accuracy_f1(test.withColumn("prediction", F.lit(float(top))), label).first().asDict()
    return {**found, "auc": 0.5}


def guess_number(train: DataFrame, test: DataFrame, label: str) -> dict[str, float]:
    """Metrics of the mean of the training rows on the test rows."""
    mean = train.agg(F.avg(F.col(label).cast("double"))).first()[0]
    return regressor_metrics(test.withColumn("_mean", F.lit(mean)), label, "_mean")


# ------------------------------------------------------------------ kept results


def kept(name: str, inputs: Sequence[DataFrame], params: object, make: Callable[[str], Result]) -> Result:
    """The result of a training, made once for the same rows, parameters and code.

    ``make`` gets the folder of the work, where a search keeps its trials.
    """
    spark = inputs[0].sparkSession
    path = work_path(spark, name, inputs, params)

    def save(result: Result, to: str) -> None:
        result.model.write().overwrite().save(f"{to}/model")
        result.predictions.write.mode("overwrite").parquet(f"{to}/predictions")
        recipe = result.recipe
        for table, rows in (recipe.tables if recipe else {}).items():
            rows.write.mode("overwrite").parquet(f"{to}/recipe/{table}")
        notes = {
            "metrics": result.metrics, "features": result.features, "best": result.best, "guess": result.guess,
            "trials": [[t.number, t.params, t.score] for t in result.trials],
            "recipe": [recipe.key, recipe.numbers, recipe.texts, list(recipe.tables)] if recipe else None,
        }
        spark.createDataFrame([(json.dumps(notes),)], "notes string").coalesce(1).write.mode("overwrite").parquet(f"{to}/notes")

    def load(at: str) -> Result:
        notes = json.loads(spark.read.parquet(f"{at}/notes").first()["notes"])
        recipe = None
        if notes["recipe"]:
            key, numbers, texts, tables = notes["recipe"]
            recipe = Recipe(key, numbers, texts, {t: spark.read.parquet(f"{at}/recipe/{t}") for t in tables})
        return Result(
            name, load_model(spark, f"{at}/model"), spark.read.parquet(f"{at}/predictions"), notes["metrics"], notes["features"],
            recipe, notes["best"], [Trial(*t) for t in notes["trials"]], notes["guess"],
        )

    return finished(spark, path, lambda: make(path), save, load)


# ------------------------------------------------------------------ user tasks


def tuned(
    train: DataFrame, key: str, label: str, objective: Objective, metric: str, space: Mapping, budget: Budget,
    names: Sequence[str], weight: str | None, log: str,
) -> tuning.Found:
    """The model whose parameters an adaptive search has found; a row's fold comes from a hash of its key."""
    fold = F.floor(prep.shuffle_share(F.col(key), SEED) * budget.folds).cast("int")
    rows = prep.assemble(held_back(train, key).withColumn("_fold", fold), names)
    ready = boosting.binned(rows, label, objective, weight=weight, held=VALIDATION, group="_fold")
    return tuning.adaptive_search(
        ready, objective, space, metric, budget.params, budget.trials, budget.folds, SEED, names, TrialLog(train.sparkSession, log)
    )


def churn(users: DataFrame, budget: Budget = Budget(TUNED_PARAMS), space: Mapping = CHURN_SPACE) -> Result:
    """Will the user leave; parameters found by adaptive search on the area under ROC."""

    def make(work: str) -> Result:
        label = "is_churned"
        ready = prepared(users, "user_id", USER_NUMBERS, USER_TEXTS, [label])
        train, test = split(ready.rows, "user_id", label)
        weighted = prep.with_class_weight(train, label, "positive")
        search = tuned(weighted, "user_id", label, Logistic(), "auc", space, budget, ready.names, "weight", f"{work}/trials")
        predictions = scored(search.model, prep.assemble(test, ready.names))
        found = classifier_metrics(predictions, label, binary=True)
        found["best_cv_auc"] = search.best.score
        return Result("churn-prediction", search.model, predictions, found, ready.names, ready.recipe, search.best.params, search.trials, guess_class(train, test, label))

    return kept("churn-prediction", [users], (budget, space), make)


def segmentation(users: DataFrame, budget: Budget = Budget(SEGMENT_PARAMS)) -> Result:
    """Which segment a user belongs to: boosted trees, one per segment and round."""

    def make(work: str) -> Result:
        ready = prepared(users, "user_id", USER_NUMBERS, USER_TEXTS, ["user_segment"])
        coded = prep.encode_categories(ready.rows, ["user_segment"], ["user_id"])
        train, test = split(stage(coded, "segments"), "user_id", "user_segment")
        label = code("user_segment")
        objective = Softmax(class_count(train, label))
        model, predictions = fit_boosted(held_back(train, "user_id"), test, label, objective, budget.params, ready.names)
        found = classifier_metrics(predictions, label, False)
        return Result("user-segmentation", model, predictions, found, ready.names, ready.recipe, guess=guess_class(train, test, label))

    return kept("user-segmentation", [users], budget, make)


def class_count(rows: DataFrame, label: str) -> int:
    return int(rows.agg(F.max(label)).first()[0] or 0) + 1


def ltv(users: DataFrame, budget: Budget = Budget(TUNED_PARAMS), space: Mapping = LTV_SPACE) -> Result:
    """Value of the user, learnt on the log scale and scored on the money scale."""

    def make(work: str) -> Result:
        ready = prepared(users, "user_id", USER_NUMBERS, USER_TEXTS, ["ltv_idr"])
        train, test = split(ready.rows.withColumn("log_ltv", X.log_target(F.col("ltv_idr"))), "user_id", None)
        search = tuned(train, "user_id", "log_ltv", Squared(), "rmse", space, budget, ready.names, None, f"{work}/trials")
        predictions = scored(search.model, prep.assemble(test, ready.names)).withColumn("predicted_ltv", X.from_log_target(F.col("prediction")))
        found = regressor_metrics(predictions, "ltv_idr", "predicted_ltv")
        found["best_cv_rmse"] = -search.best.score
        return Result("ltv-prediction", search.model, predictions, found, ready.names, ready.recipe, search.best.params, search.trials, guess_number(train, test, "ltv_idr"))

    return kept("ltv-prediction", [users], (budget, space), make)


# ------------------------------------------------------------------ transactions


def fraud(transactions: DataFrame, budget: Budget = Budget(FRAUD_PARAMS), ratio: float = 0.3) -> Result:
    """Is the transaction fraud; rare positives are topped up in the training part only."""

    def make(work: str) -> Result:
        key, label = "transaction_id", "is_fraud"
        ready = prepared(transactions, key, FRAUD_NUMBERS, FRAUD_TEXTS, [label])
        train, test = split(ready.rows, key, label)
        balanced = stage(prep.smote(train, key, label, ready.names, ratio, seed=SEED), "balanced")
        model, predictions = fit_boosted(held_back(balanced, key), test, label, Logistic(), budget.params, ready.names)
        found = classifier_metrics(predictions, label, binary=True)
        precision_recall = BinaryClassificationEvaluator(
            labelCol=label, rawPredictionCol="score", metricName="areaUnderPR", numBins=0
        )
        found["auc_pr"] = precision_recall.evaluate(predictions)
        return Result("fraud-detection", model, predictions, found, ready.names, ready.recipe, guess=guess_class(train, test, label))

    return kept("fraud-detection", [transactions], (budget, ratio), make)


# ------------------------------------------------------------------ reviews


def review_rows(reviews: DataFrame, max_features: int = 3000, min_df: int = 5) -> Prepared:
    """Reviews with their text vector, class code and numbers (missing numbers count as 0)."""
    usable = reviews.dropna(subset=["review_text", "rating", "sentiment"])
    kept = stage(
        usable.select("review_id", "review_text", "rating", "sentiment", *REVIEW_NUMBERS).fillna(
            0, subset=list(REVIEW_NUMBERS)
        ),
        "reviews",
    )
    documents = prep.tokenized(kept, "review_id", "review_text")
    fitted = prep.fit_text(kept, "review_id", "review_text", max_features, min_df, documents)
    vectors = prep.text_vectors(kept.drop("review_text"), "review_id", "review_text", fitted, documents)
    coded = prep.encode_categories(vectors, ["sentiment"], ["review_id"])
    recipe = Recipe("review_id", list(REVIEW_NUMBERS), [], {"vocabulary": fitted})
    return Prepared(stage(coded, "review-vectors"), [*REVIEW_NUMBERS, "text_vector"], recipe)


def sentiment(ready: Prepared, budget: Budget = Budget(REVIEW_PARAMS)) -> Result:
    """Class of the review from its words: boosted trees, all classes weighing the same in total."""

    def make(work: str) -> Result:
        train, test = split(ready.rows, "review_id", "sentiment")
        label = code("sentiment")
        weighted = prep.with_class_weight(held_back(train, "review_id"), label)
        objective = Softmax(class_count(train, label))
        model, predictions = fit_boosted(weighted, test, label, objective, budget.params, ready.names, "weight")
        found = classifier_metrics(predictions, label, False)
        return Result("review-sentiment", model, predictions, found, ready.names, ready.recipe, guess=guess_class(train, test, label))

    return kept("review-sentiment", [review_facts(ready)], budget, make)


def rating(ready: Prepared, budget: Budget = Budget(REVIEW_PARAMS)) -> Result:
    """Rating of the review by boosted trees; features and target come from one split."""

    def make(work: str) -> Result:
        train, test = split(ready.rows, "review_id", "sentiment")
        model, predictions = fit_boosted(held_back(train, "review_id"), test, "rating", Squared(), budget.params, ready.names)
        whole = predictions.withColumn("predicted_rating", X.clip_round_rating(F.col("prediction")))
        found = regressor_metrics(whole, "rating", "predicted_rating") | {"mse_exact": regressor_metrics(whole, "rating")["rmse"] ** 2}
        return Result("review-rating", model, whole, found, ready.names, ready.recipe, guess=guess_number(train, test, "rating"))

    return kept("review-rating", [review_facts(ready)], budget, make)


def review_facts(ready: Prepared) -> DataFrame:
    """The prepared reviews with columns that can be hashed."""
    return ready.rows.withColumn("text_vector", vector_to_array("text_vector"))


# ------------------------------------------------------------------ products


def product_rows(products: DataFrame) -> Prepared:
    labels = ["is_trending", "click_through_rate", "conversion_rate"]
    return prepared(products, "product_id", PRODUCT_NUMBERS, PRODUCT_TEXTS, labels)


def trending(ready: Prepared, budget: Budget = Budget(PRODUCT_PARAMS)) -> Result:
    def make(work: str) -> Result:
        label = "is_trending"
        train, test = split(ready.rows, "product_id", label)
        model, predictions = fit_boosted(held_back(train, "product_id"), test, label, Logistic(), budget.params, ready.names)
        found = classifier_metrics(predictions, label, binary=True)
        return Result("product-trending", model, predictions, found, ready.names, ready.recipe, guess=guess_class(train, test, label))

    return kept("product-trending", [ready.rows], budget, make)


def product_rate(ready: Prepared, label: str, budget: Budget = Budget(PRODUCT_PARAMS)) -> Result:
    """Click-through or conversion rate of a product."""
    name = "product-" + label.replace("_", "-")

    def make(work: str) -> Result:
        train, test = split(ready.rows, "product_id", None)
        model, predictions = fit_boosted(held_back(train, "product_id"), test, label, Squared(), budget.params, ready.names)
        return Result(name, model, predictions, regressor_metrics(predictions, label), ready.names, ready.recipe, guess=guess_number(train, test, label))

    return kept(name, [ready.rows], (label, budget), make)


# ------------------------------------------------------------------ searches


def search_ctr(searches: DataFrame, budget: Budget = Budget(SEARCH_PARAMS)) -> Result:
    """Will a search be clicked; both classes weigh the same in total."""

    def make(work: str) -> Result:
        filled = searches.withColumn("filter_category", F.coalesce("filter_category", F.lit("none")))
        # rows without a known purchase flag are left out too, as in the ranking task
        usable = filled.dropna(subset=["has_purchase"])
        ready = prepared(usable, "log_id", SEARCH_NUMBERS, SEARCH_TEXTS, ["is_clicked"])
        train, test = split(ready.rows, "log_id", "is_clicked")
        weighted = prep.with_class_weight(held_back(train, "log_id"), "is_clicked")
        model, predictions = fit_boosted(weighted, test, "is_clicked", Logistic(), budget.params, ready.names, "weight")
        found = classifier_metrics(predictions, "is_clicked", True)
        return Result("search-ctr", model, predictions, found, ready.names, ready.recipe, guess=guess_class(train, test, "is_clicked"))

    return kept("search-ctr", [searches], budget, make)

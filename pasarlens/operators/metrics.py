"""Evaluation of predictions, computed as aggregates over a prediction table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pasarlens.operators.ranking import running_total
from pasarlens.operators.topk import topk

# Gain per relevance grade.
LABEL_GAIN = (0, 1, 2, 3)


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def classification_report(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Precision, recall, F1 and support per class.

    Each cell of the confusion matrix counts once for its true and once for its
    predicted class, so one more small aggregate gives everything.
    """
    cells = confusion_matrix(df, label, prediction)
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n_rows")).otherwise(0)
    roles = F.array(
        F.struct(F.col("label").alias("class"), F.col("n_rows").alias("truth"), F.lit(0).cast("long").alias("guess"), hit.alias("hit")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("long").alias("truth"), F.col("n_rows").alias("guess"), F.lit(0).cast("long").alias("hit")),
    )
    sums = (
        cells.select(F.inline(roles))
        .groupBy("class")
        .agg(F.sum("hit").alias("hit"), F.sum("truth").alias("support"), F.sum("guess").alias("guess"))
    )
    precision = F.coalesce(F.try_divide("hit", "guess"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("hit", "support"), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2.0 * F.col("hit"), F.col("support") + F.col("guess")), F.lit(0.0))
    return sums.select(
        "class", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), "support"
    )


def accuracy_f1(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy and the F1 averaged with class support as weight."""
    report = classification_report(df, label, prediction)
    # recall * support is the number of hits of the class
    return report.agg(
        (F.sum(F.round(F.col("recall") * F.col("support"))) / F.sum("support")).alias("accuracy"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1_weighted"),
    )


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Exact area under the ROC curve; tied scores count half.  Null with one class.

    Rows are first reduced to one row per distinct score.  A positive beats the
    negatives with a smaller score and half of those with the same score.
    """
    scores = df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    ranked = running_total(scores, "score", ["neg"])
    doubled = F.col("pos") * (2 * F.col("cum_neg") - F.col("neg"))
    # decimal keeps the pair count exact beyond the range of a long
    wins = F.sum(doubled.cast("decimal(38,0)")).cast("double")
    return ranked.agg(
        F.try_divide(wins, 2.0 * F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("auc")
    )


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """RMSE, MAE and R2 in one aggregate."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    error = y - p
    sums = df.where(error.isNotNull()).agg(
        F.avg(error * error).alias("mse"), F.avg(F.abs(error)).alias("mae"), F.var_pop(y).alias("spread")
    )
    return sums.select(
        F.sqrt("mse").alias("rmse"), "mae", (1.0 - F.try_divide("mse", "spread")).alias("r2")
    )


def ndcg_per_query(
    df: DataFrame,
    ks: Sequence[int],
    group: str = "query_id",
    relevance: str = "relevance",
    score: str = "score",
    tie: str = "id",
    gains: Sequence[float] = LABEL_GAIN,
    without_relevant: float = 1.0,
) -> DataFrame:
    """Columns ``ndcg_<k>`` per query; a query without relevant rows scores ``without_relevant``.

    Only the first rows by score and the first by relevance of a query are needed (as many
    as the largest cut-off), and both are limited per task before the shuffle.
    """
    gain = F.array(*[F.lit(float(g)) for g in gains])[F.col(relevance)]
    rows = df.select(group, F.col(score).alias("_score"), F.col(tie).alias("_tie"), gain.alias("_gain"))
    share = F.col("_gain") / F.log2(F.col("_rank") + 1.0)

    def dcg(order: list[Column], name: str) -> DataFrame:
        best = topk(rows, [group], order, max(ks), "_rank")
        return best.groupBy(group).agg(
            *[F.sum(F.when(F.col("_rank") <= k, share)).alias(f"{name}_{k}") for k in ks]
        )

    reached = dcg([F.desc("_score"), F.asc("_tie")], "dcg")
    ideal = dcg([F.desc("_gain"), F.asc("_tie")], "ideal")
    none = F.lit(without_relevant)
    return reached.join(ideal, group).select(
        group,
        *[
            F.when(F.col(f"ideal_{k}") > 0, F.col(f"dcg_{k}") / F.col(f"ideal_{k}")).otherwise(none).alias(f"ndcg_{k}")
            for k in ks
        ],
    )


def ndcg_at_k(df: DataFrame, ks: Sequence[int] = (5, 10), **columns) -> DataFrame:
    """Mean NDCG over queries, one row per cut-off."""
    means = ndcg_per_query(df, ks, **columns).agg(
        *[F.avg(f"ndcg_{k}").alias(f"m_{k}") for k in ks], F.count(F.lit(1)).alias("n_queries")
    )
    lines = [F.struct(F.lit(k).alias("k"), F.col(f"m_{k}").alias("ndcg"), "n_queries") for k in ks]
    return means.select(F.inline(F.array(*lines)))

"""Features that look at a row's group: counts, sums and ranks next to every row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pasarlens.functions import features as X
from pasarlens.functions.exact import money_sum
from pasarlens.operators.ranking import global_ntile, ntile_in_group, rank_in_group
from pasarlens.operators.skew import join_stats, with_group_stats


def spend_tier(users: DataFrame) -> DataFrame:
    """Quarter of all users by spend, 1 = lowest."""
    return global_ntile(users, 4, "total_spend_idr", "user_id", "spend_tier")


def price_tier_in_category(products: DataFrame, window_rows: int | None = None) -> DataFrame:
    """Fifth of the category by price, 1 = cheapest."""
    return ntile_in_group(
        products,
        5,
        ["category"],
        ["final_price_idr"],
        "product_id",
        "price_tier_in_category",
        window_rows,
    )


def session_rank(interactions: DataFrame, window_rows: int | None = None) -> DataFrame:
    return rank_in_group(
        interactions,
        ["session_id"],
        ["timestamp"],
        "interaction_id",
        "session_interaction_rank",
        window_rows,
    )


def count_per_group(
    rows: DataFrame, keys: list[str], counted: str, name: str, hot_rows: int | None = None
) -> DataFrame:
    """Number of rows of the group (with a non-null ``counted``) on every row."""
    return with_group_stats(
        rows, keys, {name: F.count(counted)}, [counted], null_safe=True, hot_rows=hot_rows
    )


def amount_percentile(transactions: DataFrame, measured: DataFrame | None = None) -> DataFrame:
    """Twentieth of all transactions by amount, and whether it is one of the highest."""
    tiled = global_ntile(
        transactions,
        X.HIGH_VALUE_TILES,
        "total_idr",
        "transaction_id",
        "amount_percentile",
        measured,
    )
    return tiled.withColumn("is_high_value", X.is_high_value(F.col("amount_percentile")))


def _per_user_day(transactions: DataFrame) -> DataFrame:
    return (
        transactions.select("user_id", F.to_date("timestamp").alias("_day"), "transaction_id", "total_idr")
        .groupBy("user_id", "_day")
        .agg(
            F.count("transaction_id").alias("user_txn_per_day"),
            F.sum(F.col("total_idr").cast("decimal(18,4)")).alias("_spend"),
            F.count(F.lit(1)).alias("_size"),
        )
    )


def velocity(transactions: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Transactions of the user on that day, and whether they are too many."""
    days = _per_user_day(transactions).drop("_spend")
    return (
        join_stats(
            transactions.withColumn("_day", F.to_date("timestamp")),
            days,
            ["user_id", "_day"],
            "_size",
            ["transaction_id"],
            null_safe=True,
            hot_rows=hot_rows,
        )
        .withColumn("is_high_velocity", X.is_high_velocity(F.col("user_txn_per_day")))
        .drop("_day", "_size")
    )


def user_rfm(transactions: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Spend, number of transactions and mean order of the user on every row."""
    return _with_mean_order(
        with_group_stats(
            transactions,
            ["user_id"],
            {
                "user_total_spend": money_sum("total_idr"),
                "user_txn_count": F.count("transaction_id"),
            },
            ["transaction_id"],
            null_safe=True,
            hot_rows=hot_rows,
        )
    )


def _with_mean_order(rows: DataFrame) -> DataFrame:
    mean = F.try_divide(F.col("user_total_spend"), F.col("user_txn_count"))
    return rows.withColumn("user_avg_order", F.round(mean, 2))


def velocity_and_rfm(transactions: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """``velocity`` and ``user_rfm`` with one shuffle of the transactions.

    The user totals are rolled up from the per-day table and travel on it, so both joins
    become one on (user, day).
    """
    days = _per_user_day(transactions)
    users = days.groupBy(F.col("user_id").alias("_user")).agg(
        F.sum("_spend").cast("double").alias("user_total_spend"),
        F.sum("user_txn_per_day").alias("user_txn_count"),
    )
    stats = days.join(users, F.col("user_id").eqNullSafe(F.col("_user"))).drop("_user", "_spend")
    joined = join_stats(
        transactions.withColumn("_day", F.to_date("timestamp")),
        stats,
        ["user_id", "_day"],
        "_size",
        ["transaction_id"],
        null_safe=True,
        hot_rows=hot_rows,
    )
    return _with_mean_order(
        joined.withColumn("is_high_velocity", X.is_high_velocity(F.col("user_txn_per_day")))
    ).drop("_day", "_size")


def product_rating_stats(reviews: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Mean rating (2 decimals) and review count of the product, and the comparison."""
    rated = with_group_stats(
        reviews,
        ["product_id"],
        {
            "product_avg_rating": F.round(
                F.sum(F.col("rating").cast("long")) / F.count("rating"), 2
            ),
            "product_review_count": F.count("review_id"),
        },
        ["review_id"],
        null_safe=True,
        hot_rows=hot_rows,
    )
    return rated.withColumn(
        "is_above_avg_rating", (F.col("rating") > F.col("product_avg_rating")).cast("int")
    )


def query_frequency(searches: DataFrame, hot_rows: int | None = None) -> DataFrame:
    return count_per_group(searches, ["query"], "log_id", "query_frequency", hot_rows)


def user_search_count(searches: DataFrame, hot_rows: int | None = None) -> DataFrame:
    return count_per_group(searches, ["user_id"], "log_id", "user_search_count", hot_rows)

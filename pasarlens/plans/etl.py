"""The table jobs: clean a raw table and derive its features.

Every job is ``<name>(raw, as_of) -> DataFrame``; writing is a separate step.  Jobs with
group statistics store their raw rows once and move only those that have copies; every
later pass cleans what it reads of them, and reads only the columns it needs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pasarlens.functions import features as X
from pasarlens.operators import clean, windows
from pasarlens.operators.aggregates import interaction_agg, transaction_agg
from pasarlens.operators.joins import user_product_features
from pasarlens.sources.sinks import write_partitioned


@dataclass(frozen=True)
class TableRule:
    """Key, required columns and output folders of one table."""

    key: tuple[str, ...]
    not_null: tuple[str, ...]
    folders: tuple[str, ...]
    tasks: int


# What the tables are keyed, checked and partitioned by.
RULES = {
    "user_profiles": TableRule(("user_id",), ("user_id", "age"), ("user_segment",), 10),
    "product_catalog": TableRule(("product_id",), ("product_id", "category"), ("category",), 10),
    "user_interactions": TableRule(
        ("interaction_id",), ("user_id", "product_id", "interaction_type"), ("month", "interaction_type"), 20
    ),
    "transaction_history": TableRule(
        ("transaction_id",), ("user_id", "product_id", "total_idr"), ("year", "month"), 20
    ),
    "product_reviews": TableRule(
        ("review_id",), ("user_id", "product_id", "rating", "review_text"), ("year", "sentiment"), 15
    ),
    "search_logs": TableRule(("log_id",), ("user_id", "query"), ("year", "month"), 20),
    "user_product_matrix": TableRule(("user_id", "product_id"), (), (), 30),
}
USER_TYPES = {
    "age": "int",
    "tenure_days": "int",
    "loyalty_score": "double",
    "total_spend_idr": "double",
    "avg_order_value_idr": "double",
    "days_since_last_purchase": "int",
    "email_open_rate": "double",
}
USER_DEFAULTS = {
    "loyalty_score": 50.0,
    "total_spend_idr": 0.0,
    "avg_order_value_idr": 0.0,
    "days_since_last_purchase": 365,
    "email_open_rate": 0.0,
    "referral_count": 0,
}
PRODUCT_TYPES = {
    "base_price_idr": "double",
    "final_price_idr": "double",
    "discount_pct": "double",
    "avg_rating": "double",
    "review_count": "long",
    "stock_quantity": "int",
    "views_last_30d": "long",
    "sales_last_30d": "long",
}
PRODUCT_DEFAULTS = {"avg_rating": 0.0, "review_count": 0, "stock_quantity": 0}
TRANSACTION_TYPES = {
    "unit_price_idr": "double",
    "discount_amt_idr": "double",
    "shipping_fee_idr": "double",
    "total_idr": "double",
    "quantity": "int",
}


def _cleaned(raw: DataFrame, table: str, order_by: Sequence[str] | None = None, staged: bool = False) -> DataFrame:
    """Deduplicated rows without missing values; ``staged``: from a stored copy, for jobs that read them several times."""
    rule = RULES[table]
    if staged:
        return clean.drop_nulls(clean.staged_dedup(raw, rule.key, table, order_by), rule.not_null)
    return clean.basic_clean(raw, rule.key, rule.not_null, order_by)


# ------------------------------------------------------------------ the six tables


def clean_users(raw: DataFrame, order_by: Sequence[str] | None = None, staged: bool = False) -> DataFrame:
    typed = clean.cast_columns(_cleaned(raw, "user_profiles", order_by, staged), USER_TYPES)
    return typed.fillna(USER_DEFAULTS).withColumns(
        {"gender": X.upper_trimmed(F.col("gender")), "city": X.title_trimmed(F.col("city"))}
    )


def user_profiles(raw: DataFrame, as_of: str, order_by: Sequence[str] | None = None) -> DataFrame:
    users = clean_users(raw, order_by, staged=True)
    days = F.col("days_since_last_purchase")
    return windows.spend_tier(users).withColumns(
        {
            "age_group": X.age_group(F.col("age")),
            "recency_bucket": X.recency_bucket(days),
            "engagement_score": X.engagement_score(F.col("email_open_rate"), F.col("loyalty_score"), days),
            "is_new_user": X.is_new_user(F.col("tenure_days")),
            **X.audit(as_of),
        }
    )


def clean_products(raw: DataFrame, order_by: Sequence[str] | None = None, staged: bool = False) -> DataFrame:
    typed = clean.cast_columns(_cleaned(raw, "product_catalog", order_by, staged), PRODUCT_TYPES)
    return (
        clean.positive(typed, "final_price_idr")
        .fillna(PRODUCT_DEFAULTS)
        .withColumns(
            {"category": X.title_trimmed(F.col("category")), "brand": X.upper_trimmed(F.col("brand"))}
        )
    )


def product_catalog(raw: DataFrame, as_of: str, order_by: Sequence[str] | None = None) -> DataFrame:
    products = clean_products(raw, order_by, staged=True)
    price, discount = F.col("final_price_idr"), F.col("discount_pct")
    return windows.price_tier_in_category(products).withColumns(
        {
            "availability": X.availability(F.col("stock_quantity")),
            "is_big_discount": X.is_big_discount(discount),
            "popularity_score": X.popularity_score(
                F.col("sales_last_30d"), F.col("avg_rating"), F.col("review_count")
            ),
            "is_new_arrival": X.is_new_arrival(F.col("days_since_listed")),
            "margin_proxy": X.margin_proxy(price, discount),
            **X.audit(as_of),
        }
    )


def clean_interactions(raw: DataFrame, order_by: Sequence[str] | None = None, staged: bool = False) -> DataFrame:
    """Cleaned interactions with their score: all that the pair matrix needs."""
    rows = clean.parse_time(_cleaned(raw, "user_interactions", order_by, staged))
    score = X.implicit_score(F.col("implicit_score"), F.col("interaction_type"))
    return rows.withColumn("implicit_score", score)


def user_interactions(raw: DataFrame, as_of: str, order_by: Sequence[str] | None = None) -> DataFrame:
    rows = clean_interactions(raw, order_by, staged=True)
    ranked = windows.session_rank(rows)
    counted = windows.count_per_group(ranked, ["user_id"], "interaction_id", "user_interaction_count")
    return counted.withColumns(
        {
            **X.calendar("timestamp", "hour_of_day", "day_of_week", "week_of_year", "month", "is_weekend"),
            "funnel_stage": X.funnel_stage(F.col("interaction_type")),
            **X.audit(as_of),
        }
    )


def clean_transactions(raw: DataFrame, order_by: Sequence[str] | None = None, staged: bool = False) -> DataFrame:
    rows = clean.positive(_cleaned(raw, "transaction_history", order_by, staged), "total_idr")
    return clean.cast_columns(clean.parse_time(rows), TRANSACTION_TYPES)


def transaction_history(raw: DataFrame, as_of: str, order_by: Sequence[str] | None = None) -> DataFrame:
    rows = clean_transactions(raw, order_by, staged=True)
    # the tiles are found among the stored rows, and told after the rows have moved
    profiled = windows.amount_percentile(windows.velocity_and_rfm(rows), measured=rows)
    tiles = ["amount_percentile", "is_high_value"]
    ranked = profiled.select(*rows.columns, *tiles, *[c for c in profiled.columns if c not in {*rows.columns, *tiles}])
    odd = X.is_odd_hour(F.col("timestamp"))
    return ranked.withColumns(
        {
            **X.calendar("timestamp", "hour_of_day", "day_of_week", "month", "year", "is_weekend"),
            "is_odd_hour": odd,
            "fraud_score": X.fraud_score(odd, F.col("is_high_value"), F.col("is_high_velocity")),
            "effective_discount_pct": X.effective_discount_pct(
                F.col("discount_amt_idr"), F.col("unit_price_idr")
            ),
            **X.audit(as_of),
        }
    )


def clean_reviews(raw: DataFrame, order_by: Sequence[str] | None = None, staged: bool = False) -> DataFrame:
    rows = clean.parse_time(_cleaned(raw, "product_reviews", order_by, staged))
    rated = clean.between(clean.cast_columns(rows, {"rating": "int"}), "rating", *X.RATING_RANGE)
    return rated.withColumn("review_text", F.trim("review_text"))


def product_reviews(raw: DataFrame, as_of: str, order_by: Sequence[str] | None = None) -> DataFrame:
    rows = clean_reviews(raw, order_by, staged=True)
    return (
        windows.product_rating_stats(rows)
        .withColumns(X.text_shape("review_text"))
        .withColumns(
            {
                "sentiment": X.sentiment(F.col("rating")),
                "review_quality": X.review_quality(F.col("verified_purchase"), F.col("word_count")),
                **X.calendar("timestamp", "month", "year"),
                **X.audit(as_of),
            }
        )
    )


def clean_searches(raw: DataFrame, order_by: Sequence[str] | None = None, staged: bool = False) -> DataFrame:
    rows = clean.parse_time(_cleaned(raw, "search_logs", order_by, staged))
    return rows.withColumn("query", X.normal_query(F.col("query")))


def search_logs(raw: DataFrame, as_of: str, order_by: Sequence[str] | None = None) -> DataFrame:
    rows = clean_searches(raw, order_by, staged=True)
    counted = windows.user_search_count(windows.query_frequency(rows))
    return counted.withColumns(X.query_shape("query")).withColumns(
        {
            **X.filter_flags(*[F.col(f"filter_{c}") for c in ("category", "min_price", "max_price")]),
            **X.calendar("timestamp", "hour_of_day", "day_of_week", "month", "year", "is_weekend"),
            "is_zero_result": X.is_zero_result(F.col("n_results")),
            "is_clicked": X.clicked_or_zero(F.col("is_clicked")),
            "click_position_bucket": X.click_position_bucket(F.col("clicked_position")),
            **X.audit(as_of),
        }
    )


# ------------------------------------------------------------------ the pair matrix


def user_product_matrix(
    interactions: DataFrame, transactions: DataFrame, as_of: str, how: str = "left"
) -> DataFrame:
    """Pair features from cleaned (or fully processed) interactions and transactions."""
    return user_product_features(interaction_agg(interactions), transaction_agg(transactions), as_of, how)


# ------------------------------------------------------------------ everything

JOBS = {
    "user_profiles": user_profiles,
    "product_catalog": product_catalog,
    "user_interactions": user_interactions,
    "transaction_history": transaction_history,
    "product_reviews": product_reviews,
    "search_logs": search_logs,
}


def run_all(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    target: str,
    as_of: str,
    order_by: Mapping[str, Sequence[str]] | None = None,
) -> dict[str, str]:
    """Run every table job, write each once, and build the pair matrix from what was written."""
    written = {}
    for name, job in JOBS.items():
        rule = RULES[name]
        path = f"{target}/{name}"
        write_partitioned(job(raw[name], as_of, (order_by or {}).get(name)), path, rule.folders, rule.tasks)
        written[name] = path
    matrix = user_product_matrix(
        spark.read.parquet(written["user_interactions"]),
        spark.read.parquet(written["transaction_history"]),
        as_of,
    )
    path = f"{target}/features/user_product_matrix"
    write_partitioned(matrix, path, tasks=RULES["user_product_matrix"].tasks)
    return {**written, "user_product_matrix": path}

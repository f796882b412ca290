"""Features that need the group of a row."""

from __future__ import annotations

from pasarlens import fixtures as fx
from pasarlens.operators import windows as W
from pasarlens.plans import etl
from pasarlens.registry.base import PC_CLEAN, PR_CLEAN, SL, TH_CLEAN, UI, UP_CLEAN, Query, ask, money, rnd
from pasarlens.registry.features import CLEAN_SL, products, reviews, searches, users
from pasarlens.session import stage


def transactions(spark, folder, *columns):
    rows = etl.clean_transactions(fx.transaction_history(spark, folder), fx.TRANSACTION_TIE)
    return stage(rows.select("transaction_id", *columns), "transactions")


def spend_tier(spark, folder):
    return W.spend_tier(stage(users(spark, folder).select("user_id", "total_spend_idr"), "users"))


def price_tier(spark, folder):
    rows = stage(products(spark, folder).select("product_id", "category", "final_price_idr"), "products")
    return W.price_tier_in_category(rows).select("product_id", "category", "price_tier_in_category")


def session_rank(spark, folder):
    rows = fx.user_interactions(spark, folder).select("interaction_id", "session_id", "timestamp")
    return W.session_rank(rows).select("interaction_id", "session_interaction_rank")


def user_event_count(spark, folder):
    rows = fx.user_interactions(spark, folder).select("interaction_id", "user_id")
    return W.count_per_group(rows, ["user_id"], "interaction_id", "user_interaction_count")


def amount_percentile(spark, folder):
    return W.amount_percentile(transactions(spark, folder, "total_idr")).drop("total_idr")


def velocity(spark, folder):
    rows = transactions(spark, folder, "user_id", "timestamp", "total_idr")
    return W.velocity(rows).select("transaction_id", "user_txn_per_day", "is_high_velocity")


def user_rfm(spark, folder):
    return W.user_rfm(transactions(spark, folder, "user_id", "total_idr")).drop("total_idr")


def product_rating_stats(spark, folder):
    rows = reviews(spark, folder).select("review_id", "product_id", "rating")
    return W.product_rating_stats(rows).select("review_id", "product_avg_rating", "product_review_count")


def query_frequency(spark, folder):
    return W.query_frequency(searches(spark, folder).select("log_id", "query"))


def user_search_count(spark, folder):
    return W.user_search_count(fx.search_logs(spark, folder).select("log_id", "user_id"))


SPEND = f"cast(sum({money('total_idr')}) over (partition by user_id) as double)"
COUNT = "count(*) over (partition by user_id)"

QUERIES = [
    Query("spend_tier", spend_tier, ask(UP_CLEAN, then="select user_id, total_spend_idr, cast(ntile(4) over (order by total_spend_idr, user_id) as int) as spend_tier from up")),
    Query("price_tier_in_category", price_tier, ask(PC_CLEAN, then="select product_id, category, cast(ntile(5) over (partition by category order by final_price_idr, product_id) as int) as price_tier_in_category from pc")),
    Query("session_rank", session_rank, ask(UI, then='select interaction_id, cast(row_number() over (partition by session_id order by "timestamp", interaction_id) as int) as session_interaction_rank from user_interactions')),
    Query("user_event_count", user_event_count, ask(UI, then="select interaction_id, user_id, count(*) over (partition by user_id) as user_interaction_count from user_interactions")),
    Query(
        "amount_percentile",
        amount_percentile,
        ask(TH_CLEAN, then="""select transaction_id, amount_percentile, cast(amount_percentile >= 19 as int) as is_high_value from (
              select transaction_id, cast(ntile(20) over (order by total_idr, transaction_id) as int) as amount_percentile from th)"""),
    ),
    Query(
        "user_txn_velocity",
        velocity,
        ask(TH_CLEAN, then="""select transaction_id, user_txn_per_day, cast(user_txn_per_day > 10 as int) as is_high_velocity from (
              select transaction_id, count(*) over (partition by user_id, cast("timestamp" as date)) as user_txn_per_day from th)"""),
    ),
    Query("user_rfm", user_rfm, ask(TH_CLEAN, then=f"select transaction_id, user_id, {SPEND} as user_total_spend, {COUNT} as user_txn_count, {rnd(f'{SPEND} / {COUNT}', 2)} as user_avg_order from th")),
    Query(
        "product_rating_stats",
        product_rating_stats,
        ask(PR_CLEAN, then=f"select review_id, {rnd('sum(rating) over (partition by product_id) / count(*) over (partition by product_id)', 2)} as product_avg_rating, count(*) over (partition by product_id) as product_review_count from pr"),
    ),
    Query("query_frequency", query_frequency, ask(CLEAN_SL, then="select log_id, query, count(*) over (partition by query) as query_frequency from sl")),
    Query("user_search_count", user_search_count, ask(SL, then="select log_id, user_id, count(*) over (partition by user_id) as user_search_count from search_logs")),
]

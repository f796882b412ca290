"""The table jobs and the flagship pair matrix."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pasarlens import fixtures as fx
from pasarlens.plans import etl
from pasarlens.registry.base import (
    PC_CLEAN,
    PR_CLEAN,
    SCORE,
    SL,
    TH_CLEAN,
    UI,
    UP_CLEAN,
    Query,
    ask,
    money,
    rnd,
)


def cleaned_inputs(spark, folder):
    interactions = etl.clean_interactions(fx.user_interactions(spark, folder))
    transactions = etl.clean_transactions(fx.transaction_history(spark, folder), fx.TRANSACTION_TIE)
    return interactions, transactions


def user_product_features(spark, folder):
    return etl.user_product_matrix(*cleaned_inputs(spark, folder), fx.EVENTS_AS_OF)


def audit(as_of: str) -> str:
    return f"timestamp '{as_of} 00:00:00' as processed_at, 'v2.0' as etl_version"


UI_AGG = f"""ui_agg as (
  select user_id, product_id, cast(sum({SCORE}) as bigint) as total_implicit_score,
         count(*) as n_interactions, count(distinct interaction_type) as n_interaction_types,
         max("timestamp") as last_interaction_ts,
         cast(count(*) filter (where interaction_type = 'purchase') as bigint) as n_purchases,
         cast(count(*) filter (where interaction_type = 'add_to_cart') as bigint) as n_add_to_cart
  from user_interactions where user_id is not null and product_id is not null and interaction_type is not null
  group by user_id, product_id)"""

TH_AGG = f"""th_agg as (
  select user_id, product_id, cast(sum({money('total_idr')}) as double) as total_spend_on_product,
         cast(sum(quantity) as bigint) as total_qty_bought, count(*) as n_transactions,
         cast(sum({money('total_idr')}) as double) / count(*) as avg_order_value,
         max("timestamp") as last_purchase_ts
  from th where payment_status = 'paid' group by user_id, product_id)"""

MATRIX = """select u.user_id, u.product_id, coalesce(total_implicit_score, 0) as total_implicit_score,
  n_interactions, n_interaction_types, last_interaction_ts, n_purchases, n_add_to_cart,
  coalesce(total_spend_on_product, 0) as total_spend_on_product,
  coalesce(total_qty_bought, 0) as total_qty_bought, coalesce(n_transactions, 0) as n_transactions,
  coalesce(avg_order_value, 0) as avg_order_value, last_purchase_ts,
  cast(n_purchases > 0 as int) as has_purchased,
  cast(date_diff('day', cast(last_interaction_ts as date), date '2024-02-01') as int) as days_since_last,
  timestamp '2024-02-01 00:00:00' as processed_at
from ui_agg u left join th_agg t on u.user_id = t.user_id and u.product_id = t.product_id"""

WEIGHT = """(case when days_since_last_purchase <= 30 then 1.0::double
  when days_since_last_purchase <= 90 then 0.6::double else 0.2::double end)"""

USERS = f"""select *, cast(ntile(4) over (order by total_spend_idr, user_id) as int) as spend_tier,
  case when age < 25 then 'Gen-Z' when age < 35 then 'Millennial' when age < 45 then 'Gen-X'
       else 'Boomer' end as age_group,
  case when days_since_last_purchase <= 30 then 'active' when days_since_last_purchase <= 90 then 'warm'
       when days_since_last_purchase <= 180 then 'cooling' else 'churned' end as recency_bucket,
  {rnd(f"email_open_rate * 0.3::double + loyalty_score / 100 * 0.4::double + {WEIGHT} * 0.3::double", 4)}
    as engagement_score,
  cast(tenure_days < 30 as int) as is_new_user, {audit('2001-08-02')} from up"""

POPULARITY = (
    "ln(1 + sales_last_30d::double) * 0.5::double + avg_rating / 5 * 0.3::double"
    " + ln(1 + review_count::double) * 0.2::double"
)
MARGIN = rnd("final_price_idr * (1 - discount_pct / 100)", 2)

PRODUCTS = f"""select *,
  cast(ntile(5) over (partition by category order by final_price_idr, product_id) as int)
    as price_tier_in_category,
  case when stock_quantity > 0 then 'in_stock' else 'out_of_stock' end as availability,
  cast(discount_pct >= 30 as int) as is_big_discount, {rnd(POPULARITY, 4)} as popularity_score,
  cast(days_since_listed < 90 as int) as is_new_arrival, {MARGIN} as margin_proxy,
  {audit('2001-08-02')} from pc"""


def calendar(*parts: str) -> str:
    forms = {
        "hour_of_day": 'cast(hour("timestamp") as int) as hour_of_day',
        "day_of_week": 'cast(dayofweek("timestamp") + 1 as int) as day_of_week',
        "week_of_year": 'cast(weekofyear("timestamp") as int) as week_of_year',
        "month": 'cast(month("timestamp") as int) as month',
        "year": 'cast(year("timestamp") as int) as year',
        "is_weekend": 'cast(dayofweek("timestamp") in (0, 6) as int) as is_weekend',
    }
    return ", ".join(forms[p] for p in parts)


FUNNEL = """case when interaction_type in ('view', 'search') then 'awareness'
  when interaction_type in ('like', 'add_to_cart') then 'consideration'
  when interaction_type in ('checkout', 'purchase') then 'conversion' else 'advocacy' end as funnel_stage"""

INTERACTIONS = f"""select * replace ({SCORE} as implicit_score),
  cast(row_number() over (partition by session_id order by "timestamp", interaction_id) as int)
    as session_interaction_rank,
  count(*) over (partition by user_id) as user_interaction_count,
  {calendar('hour_of_day', 'day_of_week', 'week_of_year', 'month', 'is_weekend')}, {FUNNEL},
  {audit('2024-02-01')} from user_interactions"""

TRANSACTIONS = f"""tiled as (
  select *, cast(ntile(20) over (order by total_idr, transaction_id) as int) as amount_percentile,
    count(*) over (partition by user_id, cast("timestamp" as date)) as user_txn_per_day,
    cast(sum({money('total_idr')}) over (partition by user_id) as double) as user_total_spend,
    count(*) over (partition by user_id) as user_txn_count from th)
select *, cast(amount_percentile >= 19 as int) as is_high_value,
  cast(user_txn_per_day > 10 as int) as is_high_velocity,
  {rnd('user_total_spend / user_txn_count', 2)} as user_avg_order,
  {calendar('hour_of_day', 'day_of_week', 'month', 'year', 'is_weekend')},
  cast(hour("timestamp") < 5 as int) as is_odd_hour,
  cast(hour("timestamp") < 5 as int) + cast(amount_percentile >= 19 as int)
    + cast(user_txn_per_day > 10 as int) as fraud_score,
  {rnd('discount_amt_idr / unit_price_idr * 100', 2)} as effective_discount_pct,
  {audit('2001-08-02')} from tiled"""

SHAPE = """cast(length(review_text) as int) as char_count,
  cast(len(string_split_regex(review_text, '\\s+')) as int) as word_count,
  cast(contains(review_text, '!') as int) as has_exclamation,
  cast(contains(review_text, '?') as int) as has_question"""
SENTIMENT = """case when rating >= 4 then 'positive' when rating <= 2 then 'negative'
  else 'neutral' end as sentiment"""
QUALITY = """case when verified_purchase = 1 and word_count >= 10 then 'high'
  when word_count >= 5 then 'medium' else 'low' end as review_quality"""

REVIEWS = f"""shaped as (
  select *, {SHAPE}, {SENTIMENT},
    {rnd('sum(rating) over (partition by product_id) / count(*) over (partition by product_id)', 2)}
      as product_avg_rating,
    count(*) over (partition by product_id) as product_review_count from pr)
select *, {QUALITY}, cast(rating > product_avg_rating as int) as is_above_avg_rating,
  {calendar('month', 'year')}, {audit('2024-02-01')} from shaped"""

SEARCHES = f"""cleaned as (select * replace (lower(trim(query)) as query) from search_logs)
select * replace (cast(coalesce(is_clicked, 0) as int) as is_clicked),
  count(*) over (partition by query) as query_frequency,
  count(*) over (partition by user_id) as user_search_count,
  cast(length(query) as int) as query_length,
  cast(len(string_split_regex(query, '\\s+')) as int) as query_word_count,
  cast(filter_category is not null as int) as has_category_filter,
  cast(filter_min_price is not null or filter_max_price is not null as int) as has_price_filter,
  {calendar('hour_of_day', 'day_of_week', 'month', 'year', 'is_weekend')},
  cast(n_results = 0 as int) as is_zero_result,
  case when clicked_position = -1 then 'no_click' when clicked_position <= 3 then 'top3'
       when clicked_position <= 10 then 'top10' else 'below10' end as click_position_bucket,
  {audit('2024-02-01')} from cleaned"""


# Per output: a sum over its keys and a sum over what its job computes.
CONTENT = {
    "user_profiles": ("user_id", "total_orders"),
    "product_catalog": ("product_id", "length(category) + sales_last_30d"),
    "user_interactions": ("interaction_id", "product_id"),
    "transaction_history": ("transaction_id", "quantity"),
    "product_reviews": ("review_id", "length(review_text)"),
    "search_logs": ("log_id", "length(trim(query))"),
    "user_product_matrix": ("user_id * 1000 + product_id", "n_interactions"),
}


def etl_main(spark, folder):
    """All seven outputs written, then counted and summed up from what was written."""
    from pasarlens.session import staging_path
    from pasarlens.sources.tables import dataset_summary

    raw = {name: getattr(fx, name)(spark, folder) for name in etl.JOBS}
    ties = {"transaction_history": fx.TRANSACTION_TIE}
    written = etl.run_all(spark, raw, staging_path(spark, "etl"), fx.EVENTS_AS_OF, ties)
    tables = {name: spark.read.parquet(path) for name, path in written.items()}
    sums = [
        tables[name].select(
            F.lit(name).alias("table_name"),
            F.expr(f"cast(sum({key}) as long)").alias("key_sum"),
            F.expr(f"cast(sum({value}) as long)").alias("content_sum"),
        )
        for name, (key, value) in CONTENT.items()
    ]
    return dataset_summary(tables).join(reduce(DataFrame.unionByName, sums), "table_name")


ETL_COUNTS = " union all ".join(
    f"""select '{name}' as table_name, count(*) as n_rows, cast({columns} as int) as n_columns,
        cast(sum({CONTENT[name][0]}) as bigint) as key_sum, cast(sum({CONTENT[name][1]}) as bigint) as content_sum
      from {source}"""
    for name, columns, source in (
        ("user_profiles", 29, "up"),
        ("product_catalog", 28, "pc"),
        ("user_interactions", 17, "user_interactions"),
        ("transaction_history", 33, "th"),
        ("product_reviews", 22, "pr"),
        ("search_logs", 29, "search_logs"),
        ("user_product_matrix", 16, "ui_agg"),
    )
)

QUERIES = [
    Query("user_product_features", user_product_features, ask(UI, UI_AGG, TH_CLEAN, TH_AGG, then=MATRIX)),
    Query(
        "user_profiles",
        lambda s, d: etl.user_profiles(fx.user_profiles(s, d), fx.ORDERS_AS_OF),
        ask(UP_CLEAN, then=USERS),
    ),
    Query(
        "product_catalog",
        lambda s, d: etl.product_catalog(fx.product_catalog(s, d), fx.ORDERS_AS_OF),
        ask(PC_CLEAN, then=PRODUCTS),
    ),
    Query(
        "user_interactions",
        lambda s, d: etl.user_interactions(fx.user_interactions(s, d), fx.EVENTS_AS_OF),
        ask(UI, then=INTERACTIONS),
    ),
    Query(
        "transaction_history",
        lambda s, d: etl.transaction_history(
            fx.transaction_history(s, d), fx.ORDERS_AS_OF, fx.TRANSACTION_TIE
        ),
        f"with {TH_CLEAN},\n{TRANSACTIONS}",
    ),
    Query(
        "product_reviews",
        lambda s, d: etl.product_reviews(fx.product_reviews(s, d), fx.EVENTS_AS_OF),
        f"with {PR_CLEAN},\n{REVIEWS}",
    ),
    Query(
        "search_logs",
        lambda s, d: etl.search_logs(fx.search_logs(s, d), fx.EVENTS_AS_OF),
        f"with {SL},\n{SEARCHES}",
    ),
    Query(
        "etl_main",
        etl_main,
        ask(UP_CLEAN, PC_CLEAN, UI, UI_AGG, TH_CLEAN, PR_CLEAN, SL, then=ETL_COUNTS),
    ),
]

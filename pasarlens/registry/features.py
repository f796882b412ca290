"""Derived features, one query per feature."""

from __future__ import annotations

from pyspark.sql import functions as F

from pasarlens import fixtures as fx
from pasarlens.functions import features as X
from pasarlens.operators.aggregates import interaction_agg, score_norm
from pasarlens.plans import etl
from pasarlens.registry.base import PC, PC_CLEAN, PR_CLEAN, SCORE, SL, TH, UI, UP, UP_CLEAN, Query, ask, rnd, title
from pasarlens.registry.tables import (
    FUNNEL,
    MARGIN,
    POPULARITY,
    QUALITY,
    SENTIMENT,
    SHAPE,
    UI_AGG,
    WEIGHT,
    calendar,
)
from pasarlens.session import stage


def col(name):
    return F.col(name)


def on(source, key, **columns):
    """Query that shows the key and some expressions of one logical table."""

    def build(spark, folder):
        rows = source(spark, folder)
        return rows.select(*key, *[c.alias(n) for n, c in {n: f() for n, f in columns.items()}.items()])

    return build


def users(spark, folder):
    return etl.clean_users(fx.user_profiles(spark, folder))


def products(spark, folder):
    return etl.clean_products(fx.product_catalog(spark, folder))


def reviews(spark, folder):
    return etl.clean_reviews(fx.product_reviews(spark, folder))


def searches(spark, folder):
    return etl.clean_searches(fx.search_logs(spark, folder))


U, P, I, R, S = ["user_id"], ["product_id"], ["interaction_id"], ["review_id"], ["log_id"]
T = ["transaction_id", "product_id", "supplier_id"]
AGE = """case when age < 25 then 'Gen-Z' when age < 35 then 'Millennial' when age < 45 then 'Gen-X'
  else 'Boomer' end"""
RECENCY = """case when days_since_last_purchase <= 30 then 'active'
  when days_since_last_purchase <= 90 then 'warm' when days_since_last_purchase <= 180 then 'cooling'
  else 'churned' end"""
ENGAGEMENT = rnd(
    f"email_open_rate * 0.3::double + loyalty_score / 100 * 0.4::double + {WEIGHT} * 0.3::double", 4
)
CLEAN_SL = f"{SL}, sl as (select * replace (lower(trim(query)) as query) from search_logs)"
SHAPED = f"{PR_CLEAN}, shaped as (select *, {SHAPE} from pr)"


def fraud_signals(spark, folder):
    """Odd hour plus two given signals (the ranks and counts have their own queries)."""
    rows = fx.transaction_history(spark, folder)
    odd = X.is_odd_hour(F.col("timestamp"))
    high = X.is_high_value(F.col("quantity") % 20 + 1)
    fast = X.is_high_velocity(F.col("delivery_days"))
    return rows.select(*T, X.fraud_score(odd, high, fast).alias("fraud_score"))


def review_features(spark, folder):
    return reviews(spark, folder).select("review_id", "review_text").withColumns(X.text_shape("review_text")).drop("review_text")


def review_quality(spark, folder):
    words = X.word_count(F.col("review_text"))
    return reviews(spark, folder).select(
        "review_id", X.review_quality(F.col("verified_purchase"), words).alias("review_quality")
    )


def above_average(spark, folder):
    from pasarlens.operators.windows import product_rating_stats

    rated = reviews(spark, folder).select("review_id", "product_id", "rating")
    return product_rating_stats(rated).select("review_id", "is_above_avg_rating")


def query_features(spark, folder):
    return searches(spark, folder).select("log_id", "query").withColumns(X.query_shape("query"))


def filter_flags(spark, folder):
    flags = X.filter_flags(*[F.col(f"filter_{c}") for c in ("category", "min_price", "max_price")])
    return fx.search_logs(spark, folder).select("log_id", *[c.alias(n) for n, c in flags.items()])


def temporal(spark, folder):
    return fx.user_interactions(spark, folder).select("interaction_id", "timestamp").withColumns(
        X.calendar("timestamp")
    ).drop("timestamp")


def pair_flags(spark, folder):
    return interaction_agg(etl.clean_interactions(fx.user_interactions(spark, folder)))


def std_text(spark, folder):
    """Standard forms of user and product text in one list."""
    people = fx.user_profiles(spark, folder).select(
        F.col("user_id").alias("id"), X.upper_trimmed(col("gender")).alias("short"), X.title_trimmed(col("city")).alias("long")
    )
    goods = fx.product_catalog(spark, folder).select(
        F.col("product_id").alias("id"), X.upper_trimmed(col("brand")).alias("short"), X.title_trimmed(col("category")).alias("long")
    )
    return people.unionByName(goods)


def normalised_score(spark, folder):
    rows = etl.clean_interactions(fx.user_interactions(spark, folder)).select("interaction_id", "implicit_score")
    return score_norm(stage(rows, "scores")).select("interaction_id", F.round("score_norm", 6).alias("score_norm"))


def log_target(spark, folder):
    target = X.log_target(col("ltv_idr"))
    return fx.user_profiles(spark, folder).select(
        "user_id",
        F.round(target, 6).alias("log_ltv"),
        F.round(X.from_log_target(target), 2).alias("ltv_back"),
    )


def clip_round(spark, folder):
    return fx.table(spark, folder, "events").select(
        "event_id", X.clip_round_rating(F.floor(F.col("value")) / 2 - 2).alias("rating")
    )


QUERIES = [
    Query("age_group", on(users, U, age_group=lambda: X.age_group(col("age"))), ask(UP_CLEAN, then=f"select user_id, {AGE} as age_group from up")),
    Query("recency_bucket", on(users, U, recency_bucket=lambda: X.recency_bucket(col("days_since_last_purchase"))), ask(UP_CLEAN, then=f"select user_id, {RECENCY} as recency_bucket from up")),
    Query(
        "engagement_score",
        on(users, U, engagement_score=lambda: X.engagement_score(col("email_open_rate"), col("loyalty_score"), col("days_since_last_purchase"))),
        ask(UP_CLEAN, then=f"select user_id, {ENGAGEMENT} as engagement_score from up"),
    ),
    Query("is_new_user", on(users, U, is_new_user=lambda: X.is_new_user(col("tenure_days"))), ask(UP_CLEAN, then="select user_id, cast(tenure_days < 30 as int) as is_new_user from up")),
    Query("availability", on(products, P, availability=lambda: X.availability(col("stock_quantity"))), ask(PC_CLEAN, then="select product_id, case when stock_quantity > 0 then 'in_stock' else 'out_of_stock' end as availability from pc")),
    Query("is_big_discount", on(products, P, is_big_discount=lambda: X.is_big_discount(col("discount_pct"))), ask(PC_CLEAN, then="select product_id, cast(discount_pct >= 30 as int) as is_big_discount from pc")),
    Query(
        "popularity_score",
        on(products, P, popularity_score=lambda: X.popularity_score(col("sales_last_30d"), col("avg_rating"), col("review_count"))),
        ask(PC_CLEAN, then=f"select product_id, {rnd(POPULARITY, 4)} as popularity_score from pc"),
    ),
    Query("is_new_arrival", on(products, P, is_new_arrival=lambda: X.is_new_arrival(col("days_since_listed"))), ask(PC_CLEAN, then="select product_id, cast(days_since_listed < 90 as int) as is_new_arrival from pc")),
    Query("margin_proxy", on(products, P, margin_proxy=lambda: X.margin_proxy(col("final_price_idr"), col("discount_pct"))), ask(PC_CLEAN, then=f"select product_id, {MARGIN} as margin_proxy from pc")),
    Query("implicit_score", on(fx.user_interactions, I, implicit_score=lambda: X.implicit_score(col("implicit_score"), col("interaction_type"))), ask(UI, then=f"select interaction_id, {SCORE} as implicit_score from user_interactions")),
    Query("temporal_features", temporal, ask(UI, then=f"select interaction_id, {calendar('hour_of_day', 'day_of_week', 'week_of_year', 'month', 'year', 'is_weekend')} from user_interactions")),
    Query("funnel_stage", on(fx.user_interactions, I, funnel_stage=lambda: X.funnel_stage(col("interaction_type"))), ask(UI, then=f"select interaction_id, {FUNNEL} from user_interactions")),
    Query("is_odd_hour", on(fx.transaction_history, T, is_odd_hour=lambda: X.is_odd_hour(col("timestamp"))), ask(TH, then='select transaction_id, product_id, supplier_id, cast(hour("timestamp") < 5 as int) as is_odd_hour from transaction_history')),
    Query(
        "fraud_score",
        fraud_signals,
        ask(TH, then="""select transaction_id, product_id, supplier_id, cast(hour("timestamp") < 5 as int)
              + cast(quantity % 20 + 1 >= 19 as int) + cast(delivery_days > 10 as int) as fraud_score
              from transaction_history"""),
    ),
    Query(
        "effective_discount_pct",
        on(fx.transaction_history, T, effective_discount_pct=lambda: X.effective_discount_pct(col("discount_amt_idr"), col("unit_price_idr"))),
        ask(TH, then=f"select transaction_id, product_id, supplier_id, {rnd('discount_amt_idr / unit_price_idr * 100', 2)} as effective_discount_pct from transaction_history"),
    ),
    Query("review_text_features", review_features, ask(SHAPED, then="select review_id, char_count, word_count, has_exclamation, has_question from shaped")),
    Query("sentiment", on(reviews, R, sentiment=lambda: X.sentiment(col("rating"))), ask(PR_CLEAN, then=f"select review_id, {SENTIMENT} from pr")),
    Query("review_quality", review_quality, ask(SHAPED, then=f"select review_id, {QUALITY} from shaped")),
    Query(
        "is_above_avg_rating",
        above_average,
        ask(PR_CLEAN, then=f"select review_id, cast(rating > {rnd('sum(rating) over (partition by product_id) / count(*) over (partition by product_id)', 2)} as int) as is_above_avg_rating from pr"),
    ),
    Query("query_features", query_features, ask(CLEAN_SL, then="select log_id, query, cast(length(query) as int) as query_length, cast(len(string_split_regex(query, '\\s+')) as int) as query_word_count from sl")),
    Query("filter_flags", filter_flags, ask(SL, then="select log_id, cast(filter_category is not null as int) as has_category_filter, cast(filter_min_price is not null or filter_max_price is not null as int) as has_price_filter from search_logs")),
    Query("is_zero_result", on(fx.search_logs, S, is_zero_result=lambda: X.is_zero_result(col("n_results"))), ask(SL, then="select log_id, cast(n_results = 0 as int) as is_zero_result from search_logs")),
    Query(
        "click_position_bucket",
        on(fx.search_logs, S, click_position_bucket=lambda: X.click_position_bucket(col("clicked_position"))),
        ask(SL, then="select log_id, case when clicked_position = -1 then 'no_click' when clicked_position <= 3 then 'top3' when clicked_position <= 10 then 'top10' else 'below10' end as click_position_bucket from search_logs"),
    ),
    Query(
        "std_text",
        std_text,
        ask(UP, PC, then=f"""select user_id as id, upper(trim(gender)) as short, {title('trim(city)')} as long
              from user_profiles union all
              select product_id, upper(trim(brand)), {title('trim(category)')} from product_catalog"""),
    ),
    Query(
        "has_purchased",
        lambda s, d: pair_flags(s, d).select("user_id", "product_id", X.has_purchased(col("n_purchases")).alias("has_purchased")),
        ask(UI, UI_AGG, then="select user_id, product_id, cast(n_purchases > 0 as int) as has_purchased from ui_agg"),
    ),
    Query(
        "days_since_last",
        lambda s, d: pair_flags(s, d).select("user_id", "product_id", X.days_since(fx.EVENTS_AS_OF, col("last_interaction_ts")).alias("days_since_last")),
        ask(UI, UI_AGG, then="select user_id, product_id, cast(date_diff('day', cast(last_interaction_ts as date), date '2024-02-01') as int) as days_since_last from ui_agg"),
    ),
    Query("relevance_label", on(fx.search_logs, S, relevance=lambda: X.relevance(col("is_clicked"), col("has_purchase"))), ask(SL, then="select log_id, is_clicked + 2 * has_purchase as relevance from search_logs")),
    Query("log_target", log_target, ask(UP, then=f"select user_id, {rnd('ln(1 + ltv_idr)', 6)} as log_ltv, {rnd('exp(ln(1 + ltv_idr)) - 1', 2)} as ltv_back from user_profiles")),
    Query("score_norm", normalised_score, ask(UI, then=f"select interaction_id, {rnd(f'{SCORE} / max({SCORE}) over ()', 6)} as score_norm from user_interactions")),
    Query(
        "clip_round_rating",
        clip_round,
        "select event_id, least(greatest(round_even(floor(value) / 2 - 2, 0), 1.0::double), 5.0::double) as rating from events",
    ),
]

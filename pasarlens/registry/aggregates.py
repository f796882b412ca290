"""Grouped and global aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from pasarlens import fixtures as fx
from pasarlens.operators import aggregates as A
from pasarlens.operators.joins import union_pairs
from pasarlens.plans import etl
from pasarlens.registry.base import SCORE, SL, TH, TH_CLEAN, UI, UP, Query, ask, rnd
from pasarlens.registry.tables import TH_AGG, UI_AGG

STACKED = f"""{UI}, {TH},
pairs as (select user_id, product_id from user_interactions union all
          select user_id, product_id from transaction_history),
cells as (select user_id, product_id, count(*) as n_events from pairs
          where user_id is not null and product_id is not null group by all)"""


def pairs(spark, folder):
    return union_pairs(fx.user_interactions(spark, folder), fx.transaction_history(spark, folder))


def ui_agg(spark, folder):
    return A.interaction_agg(etl.clean_interactions(fx.user_interactions(spark, folder)))


def th_agg(spark, folder):
    return A.transaction_agg(etl.clean_transactions(fx.transaction_history(spark, folder), fx.TRANSACTION_TIE))


def class_rate(spark, folder):
    return A.class_rate(fx.user_profiles(spark, folder), "is_churned").withColumn(
        "positive_rate", F.round("positive_rate", 8)
    )


def class_ratio(spark, folder):
    return A.class_ratio(fx.user_profiles(spark, folder), "is_churned").withColumn(
        "class_ratio", F.round("class_ratio", 8)
    )


def global_max(spark, folder):
    return A.global_max(etl.clean_interactions(fx.user_interactions(spark, folder)), "implicit_score")


STATS = """select (select count(distinct user_id) from cells) as total_users,
  (select count(distinct product_id) from cells) as total_products,
  (select count(distinct user_id) from cells) as matrix_rows,
  (select count(distinct product_id) from cells) as matrix_columns, count(*) as total_interactions,
  printf('%.4f%%', count(*) * 100.0::double / ((select count(distinct user_id) from cells)::double
    * (select count(distinct product_id) from cells))) as density from cells"""

QUERIES = [
    Query("ui_agg", ui_agg, ask(UI, UI_AGG, then="select * from ui_agg")),
    Query("th_agg", th_agg, ask(TH_CLEAN, TH_AGG, then="select * from th_agg")),
    Query("pair_counts", lambda s, d: A.interaction_matrix(pairs(s, d)), ask(STACKED, then="select * from cells")),
    Query(
        "distinct_counts",
        lambda s, d: A.cf_cardinality(fx.user_interactions(s, d)),
        ask(UI, then="""select count(distinct user_id) as n_users, count(distinct product_id) as n_items,
                        count(*) as n_rows from user_interactions"""),
    ),
    Query("matrix_stats", lambda s, d: A.matrix_stats(A.interaction_matrix(pairs(s, d))), ask(STACKED, then=STATS)),
    Query(
        "group_sizes",
        lambda s, d: A.group_sizes(etl.clean_searches(fx.search_logs(s, d)), "query"),
        ask(SL, then="select lower(trim(query)) as query, count(*) as group_size from search_logs group by all"),
    ),
    Query(
        "value_counts",
        lambda s, d: A.value_counts(fx.user_profiles(s, d), "user_segment"),
        ask(UP, then="select user_segment, count(*) as n_rows from user_profiles group by all"),
    ),
    Query("class_rate", class_rate, ask(UP, then=f"select {rnd('sum(is_churned) / count(is_churned)', 8)} as positive_rate from user_profiles")),
    Query("global_max", global_max, ask(UI, then=f"select max({SCORE}) as max_implicit_score from user_interactions")),
    Query(
        "class_ratio",
        class_ratio,
        ask(UP, then=f"""select n_negative, n_positive, {rnd('n_negative / n_positive', 8)} as class_ratio from (
              select count(*) filter (where is_churned = 0) as n_negative,
                     count(*) filter (where is_churned = 1) as n_positive from user_profiles)"""),
    ),
]

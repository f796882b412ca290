"""Joins, set operations, sorted and top-k results."""

from __future__ import annotations

from pyspark.sql import functions as F

from pasarlens import fixtures as fx
from pasarlens.operators import joins as J
from pasarlens.operators import prep
from pasarlens.operators.aggregates import interaction_matrix
from pasarlens.operators.topk import head_n, sort_desc, top_n, topk
from pasarlens.plans import etl
from pasarlens.registry.aggregates import STACKED, pairs, ui_agg
from pasarlens.registry.base import PC, PR, SL, TH_CLEAN, UI, Query, ask, rnd
from pasarlens.registry.tables import MATRIX, TH_AGG, UI_AGG, cleaned_inputs

SEED = 42
TOP = 10


def user_product_matrix_full(spark, folder):
    """The pair matrix with pairs that have transactions only kept as well."""
    full = etl.user_product_matrix(*cleaned_inputs(spark, folder), fx.EVENTS_AS_OF, how="full")
    return full.select("user_id", "product_id", "n_interactions", "n_transactions", "total_qty_bought")


def best_products(spark, folder, k=TOP):
    """The k products each user engaged with most."""
    order = [F.desc("total_implicit_score"), F.desc("n_interactions"), F.asc("product_id")]
    scored = ui_agg(spark, folder).fillna(0)
    return topk(scored, ["user_id"], order, k).select("user_id", "product_id", "total_implicit_score", "rank")


def recs_with_metadata(spark, folder):
    return J.enrich(best_products(spark, folder), fx.product_catalog(spark, folder))


def id_encode(spark, folder):
    cells = interaction_matrix(pairs(spark, folder))
    encoded, _ = prep.encode_ids(
        cells,
        {"user_id": "user_idx", "product_id": "product_idx"},
        {"user_id": ["product_id"], "product_id": ["user_id"]},
    )
    return encoded


def _queries_split(inside):
    def build(spark, folder):
        rows = etl.clean_searches(fx.search_logs(spark, folder)).select("log_id", "query")
        train, test = prep.group_split(rows, "query", 0.2, SEED, ["log_id"])
        return train if inside else test

    return build


def hstack_features(spark, folder):
    reviews = fx.product_reviews(spark, folder)
    numbers = reviews.select("review_id", "helpful_votes", "verified_purchase", "has_photo")
    texts = etl.clean_reviews(reviews).select("review_id", F.length("review_text").alias("char_count"))
    return J.hstack(numbers, texts, "review_id")


GROUPS = f"""{SL},
sl as (select log_id, lower(trim(query)) as query from search_logs),
groups as (select query, row_number() over (order by substr(md5(query || '#{SEED}'), 1, 26)) - 1 as place,
             count(*) over () as n from (select distinct query from sl)),
train as (select query from groups where place < n - ceil(0.2::double * n))"""
BEST = f"""ranked as (
  select user_id, product_id, coalesce(total_implicit_score, 0) as total_implicit_score,
    cast(row_number() over (partition by user_id order by coalesce(total_implicit_score, 0) desc,
      n_interactions desc, product_id) as int) as rank from ui_agg),
best as (select * from ranked where rank <= {TOP})"""

QUERIES = [
    Query(
        "user_product_matrix",
        lambda s, d: etl.user_product_matrix(*cleaned_inputs(s, d), fx.EVENTS_AS_OF),
        ask(UI, UI_AGG, TH_CLEAN, TH_AGG, then=MATRIX),
    ),
    Query(
        "user_product_matrix_full",
        user_product_matrix_full,
        ask(UI, UI_AGG, TH_CLEAN, TH_AGG, then="""select coalesce(u.user_id, t.user_id) as user_id,
          coalesce(u.product_id, t.product_id) as product_id, coalesce(n_interactions, 0) as n_interactions,
          coalesce(n_transactions, 0) as n_transactions, coalesce(total_qty_bought, 0) as total_qty_bought
          from ui_agg u full join th_agg t on u.user_id = t.user_id and u.product_id = t.product_id"""),
    ),
    Query(
        "recs_with_metadata",
        recs_with_metadata,
        ask(UI, UI_AGG, BEST, PC, then="""select b.*, product_name, category, final_price_idr
          from best b left join product_catalog p on b.product_id = p.product_id"""),
    ),
    Query(
        "id_encode",
        id_encode,
        ask(STACKED, then="""select *, dense_rank() over (order by user_id) - 1 as user_idx,
          dense_rank() over (order by product_id) - 1 as product_idx from cells"""),
    ),
    Query("group_split_semi", _queries_split(True), ask(GROUPS, then="select log_id, query from sl where query in (select query from train)")),
    Query("group_split_anti", _queries_split(False), ask(GROUPS, then="select log_id, query from sl where query not in (select query from train)")),
    Query(
        "unseen_candidates",
        lambda s, d: J.unseen_counts(fx.user_interactions(s, d)),
        ask(UI, then="""select user_id, count(distinct product_id) as n_seen,
          (select count(distinct product_id) from user_interactions) - count(distinct product_id) as n_unseen
          from user_interactions group by user_id"""),
    ),
    Query("union_all_pairs", pairs, ask(STACKED, then="select user_id, product_id, cast(1 as int) as interaction from pairs")),
    Query("distinct_values", lambda s, d: J.distinct_values(etl.clean_searches(fx.search_logs(s, d)), "query"), ask(SL, then="select distinct lower(trim(query)) as query from search_logs")),
    Query(
        "hstack_features",
        hstack_features,
        ask(PR, then="""select review_id, helpful_votes, verified_purchase, has_photo,
          cast(case when rating between 1 and 5 then length(trim(review_text)) end as int) as char_count
          from product_reviews"""),
    ),
    Query("topk_per_user", best_products, ask(UI, UI_AGG, BEST, then="select * from best")),
    Query(
        "topn_global",
        lambda s, d: top_n(fx.product_catalog(s, d).select("product_id", "sales_last_30d"), [F.desc("sales_last_30d"), "product_id"], 20),
        ask(PC, then="select product_id, sales_last_30d from product_catalog order by sales_last_30d desc, product_id limit 20"),
    ),
    Query(
        "sort_desc",
        lambda s, d: sort_desc(fx.product_catalog(s, d).select("product_id", F.round("final_price_idr", 2).alias("price")), "price", "product_id"),
        ask(PC, then=f"select product_id, {rnd('final_price_idr', 2)} as price from product_catalog order by 2 desc, 1"),
    ),
    Query(
        "head_n",
        lambda s, d: head_n(fx.user_interactions(s, d).select("interaction_id", "user_id", "product_id"), "interaction_id", 5),
        ask(UI, then="select interaction_id, user_id, product_id from user_interactions order by interaction_id limit 5"),
    ),
]

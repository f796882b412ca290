"""Recommendation serving as batch jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from pasarlens import fixtures as fx
from pasarlens.operators import joins as J
from pasarlens.operators.aggregates import interaction_matrix, matrix_stats
from pasarlens.operators.recommend import answer_requests, parse_requests, recommendation_lists
from pasarlens.registry.aggregates import STACKED, STATS, pairs
from pasarlens.registry.base import REQ, UI, Query, ask
from pasarlens.registry.joins import best_products
from pasarlens.registry.tables import UI_AGG
from pasarlens.session import stage, staging_path
from pasarlens.sources import keyed_recs
from pasarlens.streaming.serving import answer_from_store, serve_stream


def serve_requests(spark, folder):
    """Requests answered from lists as deep as the largest n that was asked for."""
    asked = fx.requests(spark, folder)
    depth = parse_requests(asked).agg(F.max("n")).first()[0] or 1
    lists = recommendation_lists(best_products(spark, folder, depth))
    answers = answer_requests(asked, stage(lists, "lists"), fx.EVENTS_AS_OF)
    return answers.select("request_id", "status", "response")


def serve_stream_requests(spark, folder):
    """The same requests as files of a stream; the responses of all its batches."""
    asked = fx.requests(spark, folder)
    depth = parse_requests(asked).agg(F.max("n")).first()[0] or 1
    lists = stage(recommendation_lists(best_products(spark, folder, depth)), "lists")
    source = stage(asked, "requests").inputFiles()[0].rsplit("/", 1)[0]
    root = staging_path(spark, "stream")
    serve_stream(spark, source, lists, f"{root}/responses", f"{root}/store", f"{root}/progress", fx.EVENTS_AS_OF)
    return spark.read.parquet(f"{root}/responses").select("request_id", "status", "response")


def serve_from_store(spark, folder):
    """The same requests from a keyed store: outdated lists first, then the right ones in two batches, merged in between."""
    asked = fx.requests(spark, folder)
    depth = parse_requests(asked).agg(F.max("n")).first()[0] or 1
    lists = stage(recommendation_lists(best_products(spark, folder, depth)), "lists")
    path = staging_path(spark, "keyed")
    outdated = lists.select("user_id", F.reverse("recommendations").alias("recommendations"), F.lit("2024-01-01").alias("timestamp"))
    fresh = lists.withColumn("timestamp", F.lit("2024-02-01"))
    keyed_recs.put_keyed(outdated, path, 0)
    keyed_recs.put_keyed(fresh.where(F.xxhash64("user_id") % 2 == 0), path, 1)
    keyed_recs.compact(spark, path, 2)
    keyed_recs.put_keyed(fresh.where(F.xxhash64("user_id") % 2 != 0), path, 2)
    return answer_from_store(asked, path, fx.EVENTS_AS_OF).select("request_id", "status", "response")


def unseen_items_of_users(spark, folder):
    """Every product that a user whose id is divisible by 50 has not touched, as rows."""
    rows = stage(fx.user_interactions(spark, folder).select("user_id", "product_id"), "pairs")
    return J.unseen_of_users(rows, rows.where(F.col("user_id") % 50 == 0))


def history_of_users(spark, folder):
    """History of all users that the requests ask for; each that nobody knows gives a row with an error."""
    asked = parse_requests(fx.requests(spark, folder)).where("status = 200").select("user_id")
    events = fx.user_interactions(spark, folder).withColumn("user_id", F.col("user_id").cast("string"))
    return J.history_of(asked, events)


def user_interactions_list(spark, folder):
    return J.user_history(fx.user_interactions(spark, folder))


SERVED = """lists as (
  select user_id, list(product_id order by rank) as products from (
    select user_id, product_id, row_number() over (partition by user_id
      order by coalesce(total_implicit_score, 0) desc, n_interactions desc, product_id) as rank from ui_agg)
  group by user_id)
select request_id, status, case when status = 200 then
    '{"user_id":"' || o.user_id || '","recommendations":['
      || coalesce(array_to_string(products[1:n], ','), '') || '],"timestamp":"2024-02-01T00:00:00Z"}'
  else '{"error":"' || error || '"}' end as response
from opened o left join lists l on o.user_id = cast(l.user_id as varchar)"""

UNSEEN = """select distinct user_id, product_id
from (select distinct user_id from user_interactions where user_id % 50 = 0),
  (select distinct product_id from user_interactions where product_id is not null)
except select user_id, product_id from user_interactions"""
HISTORY = """asked as (select distinct user_id from opened where status = 200),
touched as (select distinct cast(user_id as varchar) as user_id, product_id from user_interactions
  where user_id is not null and product_id is not null)
select user_id, product_id, count(*) over (partition by user_id) as total_interactions,
  cast(null as varchar) as error
from touched where user_id in (select user_id from asked)
union all
select user_id, null, null, 'User not found' from asked where user_id not in (select user_id from touched)"""

QUERIES = [
    Query("serve_requests", serve_requests, "with " + ",\n".join([REQ, UI, UI_AGG, SERVED])),
    Query("serve_stream", serve_stream_requests, "with " + ",\n".join([REQ, UI, UI_AGG, SERVED])),
    Query("serve_from_store", serve_from_store, "with " + ",\n".join([REQ, UI, UI_AGG, SERVED])),
    Query("unseen_items", unseen_items_of_users, ask(UI, then=UNSEEN)),
    Query("history_of_users", history_of_users, "with " + ",\n".join([REQ, UI, HISTORY])),
    Query(
        "list_users",
        lambda s, d: J.ids_with_total(fx.user_interactions(s, d), "user_id"),
        ask(UI, then="select user_id, count(*) over () as total from (select distinct user_id from user_interactions)"),
    ),
    Query(
        "list_products",
        lambda s, d: J.ids_with_total(fx.user_interactions(s, d), "product_id"),
        ask(UI, then="""select product_id, count(*) over () as total
                        from (select distinct product_id from user_interactions)"""),
    ),
    Query(
        "user_interaction_history",
        user_interactions_list,
        ask(UI, then="""select user_id, product_id, count(*) over (partition by user_id) as total_interactions
                        from (select distinct user_id, product_id from user_interactions)"""),
    ),
    Query("recommender_stats", lambda s, d: matrix_stats(interaction_matrix(pairs(s, d))), ask(STACKED, then=STATS)),
]

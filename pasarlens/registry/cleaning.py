"""Cleaning steps, one query per step."""

from __future__ import annotations

from pyspark.sql import functions as F

from pasarlens import fixtures as fx
from pasarlens.functions import features as X
from pasarlens.operators import clean
from pasarlens.operators.recommend import parse_requests
from pasarlens.registry.base import PC, PR, REQ, SL, TH, UI, UP, Query, ask

SURVIVOR = """qualify row_number() over (
  partition by transaction_id order by product_id, supplier_id, subtotal_idr) = 1"""


def dedup_by_key(spark, folder):
    kept = clean.dedup(fx.transaction_history(spark, folder), ["transaction_id"], fx.TRANSACTION_TIE)
    return kept.select("transaction_id", "user_id", "product_id", "supplier_id", "total_idr")


def dropna_subset(spark, folder):
    rows = clean.drop_nulls(fx.search_logs(spark, folder), ["filter_category", "is_clicked"])
    return rows.select("log_id", "filter_category", "is_clicked", "filter_min_price")


def dropna_all(spark, folder):
    columns = ("log_id", "filter_category", "is_clicked", "filter_min_price", "filter_max_price")
    return clean.drop_nulls(fx.search_logs(spark, folder).select(*columns))


def clean_report(spark, folder):
    rows = fx.transaction_history(spark, folder).select(
        "transaction_id", *fx.TRANSACTION_TIE, "user_id", "total_idr"
    )
    return clean.clean_report(
        rows, ["transaction_id"], ["user_id", "product_id", "total_idr"], "transaction_history"
    )


def typed_cast(spark, folder):
    """Text columns of the search log, some of it no number, cast with nulls for bad text."""
    logs = fx.search_logs(spark, folder).select(
        "log_id",
        F.when(F.col("n_results") == 0, F.lit("none")).otherwise(F.col("n_results").cast("string")).alias("n_results"),
        F.regexp_extract("query", r"(\d+)", 1).alias("item"),
        F.col("sort_by").alias("price"),
    )
    return clean.cast_columns(logs, {"n_results": "int", "item": "long", "price": "double"})


def impute_const(spark, folder):
    logs = fx.search_logs(spark, folder).select(
        "log_id", "filter_category", "filter_min_price", "clicked_position"
    )
    return logs.fillna({"filter_category": "none", "filter_min_price": 50.0, "clicked_position": 365})


def impute_zero_numeric(spark, folder):
    logs = fx.search_logs(spark, folder)
    return logs.select("log_id", "filter_category", "filter_min_price", "filter_max_price", "is_clicked").fillna(0)


def coalesce_default(spark, folder):
    logs = fx.search_logs(spark, folder)
    return logs.select("log_id", X.clicked_or_zero(F.col("is_clicked")).alias("is_clicked"))


def filter_positive(spark, folder):
    rows = clean.positive(fx.product_catalog(spark, folder), "final_price_idr")
    return rows.select("product_id", "final_price_idr")


def filter_between(spark, folder):
    rows = clean.between(fx.product_reviews(spark, folder), "rating", *X.RATING_RANGE)
    return rows.select("review_id", "rating")


def filter_equals(spark, folder):
    rows = clean.equals(fx.transaction_history(spark, folder), "payment_status", "paid")
    return rows.select("transaction_id", "product_id", "supplier_id", "payment_status")


def project_subset(spark, folder):
    return fx.user_profiles(spark, folder).select("user_id", "age", "gender", "city", "total_orders", "is_churned").drop("is_churned")


def audit_columns(spark, folder):
    return fx.user_interactions(spark, folder).select("interaction_id").withColumns(X.audit(fx.EVENTS_AS_OF))


def invalid_request_filter(spark, folder):
    return parse_requests(fx.requests(spark, folder)).select("request_id", "user_id", "n", "status", "error")


QUERIES = [
    Query(
        "dedup_by_key",
        dedup_by_key,
        ask(TH, then=f"select transaction_id, user_id, product_id, supplier_id, total_idr from transaction_history {SURVIVOR}"),
    ),
    Query(
        "dropna_subset",
        dropna_subset,
        ask(SL, then="""select log_id, filter_category, is_clicked, filter_min_price from search_logs
                        where filter_category is not null and is_clicked is not null"""),
    ),
    Query(
        "dropna_all",
        dropna_all,
        ask(SL, then="""select log_id, filter_category, is_clicked, filter_min_price, filter_max_price
                        from search_logs where filter_category is not null and is_clicked is not null
                        and filter_min_price is not null and filter_max_price is not null"""),
    ),
    Query(
        "clean_report",
        clean_report,
        ask(TH, then="""select 'transaction_history' as table_name, count(*) as rows_before,
                        count(distinct transaction_id) as rows_after,
                        count(*) - count(distinct transaction_id) as rows_dropped from transaction_history"""),
    ),
    Query(
        "typed_cast",
        typed_cast,
        ask(SL, then="""select log_id, case when n_results <> 0 then n_results end as n_results,
                        cast(regexp_extract(query, '(\\d+)', 1) as bigint) as item,
                        cast(null as double) as price from search_logs"""),
    ),
    Query(
        "impute_const",
        impute_const,
        ask(SL, then="""select log_id, coalesce(filter_category, 'none') as filter_category,
                        coalesce(filter_min_price, 50.0::double) as filter_min_price,
                        coalesce(clicked_position, 365) as clicked_position from search_logs"""),
    ),
    Query(
        "impute_zero_numeric",
        impute_zero_numeric,
        ask(SL, then="""select log_id, filter_category, coalesce(filter_min_price, 0) as filter_min_price,
                        coalesce(filter_max_price, 0) as filter_max_price,
                        coalesce(is_clicked, 0) as is_clicked from search_logs"""),
    ),
    Query(
        "coalesce_default",
        coalesce_default,
        ask(SL, then="select log_id, coalesce(is_clicked, 0) as is_clicked from search_logs"),
    ),
    Query(
        "filter_positive",
        filter_positive,
        ask(PC, then="select product_id, final_price_idr from product_catalog where final_price_idr > 0"),
    ),
    Query(
        "filter_between",
        filter_between,
        ask(PR, then="select review_id, rating from product_reviews where rating between 1 and 5"),
    ),
    Query(
        "filter_equals",
        filter_equals,
        ask(TH, then="""select transaction_id, product_id, supplier_id, payment_status
                        from transaction_history where payment_status = 'paid'"""),
    ),
    Query(
        "project_subset",
        project_subset,
        ask(UP, then="select user_id, age, gender, city, total_orders from user_profiles"),
    ),
    Query(
        "audit_columns",
        audit_columns,
        ask(UI, then="""select interaction_id, timestamp '2024-02-01 00:00:00' as processed_at,
                        'v2.0' as etl_version from user_interactions"""),
    ),
    Query(
        "invalid_request_filter",
        invalid_request_filter,
        ask(REQ, then="select request_id, user_id, n, status, error from opened"),
    ),
]

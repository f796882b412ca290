"""Views of the TPC-H-like test tables as the logical retail tables.

Each function reads ``<dir>/<table>.parquet`` and returns one logical table; nothing is
filtered or sampled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pasarlens.functions.exact import money

ORDERS_AS_OF = "2001-08-02"
EVENTS_AS_OF = "2024-02-01"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def user_interactions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("event_id").alias("interaction_id"),
        "user_id",
        _k().cast("long").alias("product_id"),
        F.col("event_type").alias("interaction_type"),
        F.lit(None).cast("int").alias("implicit_score"),
        F.col("ts").alias("timestamp"),
        F.concat_ws("-", F.col("user_id").cast("string"), F.to_date("ts").cast("string")).alias(
            "session_id"
        ),
    )


def transaction_history(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"
    )
    price, discount, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("supplier_id"),
        (F.col("o_orderdate") + F.make_dt_interval(hours=(F.col("l_partkey") % 24).cast("int"))).alias(
            "timestamp"
        ),
        F.floor("l_quantity").cast("int").alias("quantity"),
        (price / F.col("l_quantity")).alias("unit_price_idr"),
        (price * discount).alias("discount_amt_idr"),
        (price * tax).alias("shipping_fee_idr"),
        price.alias("subtotal_idr"),
        (price * (1 - discount) * (1 + tax)).alias("total_idr"),
        F.when(F.col("l_linestatus") == "F", "paid").otherwise("pending").alias("payment_status"),
        F.col("l_returnflag").alias("payment_method"),
        F.col("o_orderpriority").alias("platform"),
        F.datediff("l_shipdate", "o_orderdate").alias("delivery_days"),
        ((F.col("l_returnflag") == "R") & (discount >= 0.09)).cast("int").alias("is_fraud"),
    )


# Copies of one transaction differ in these columns, so they fix which copy survives.
TRANSACTION_TIE = ("product_id", "supplier_id", "subtotal_idr")


def user_profiles(spark: SparkSession, folder: str) -> DataFrame:
    as_of = F.lit(ORDERS_AS_OF).cast("date")
    spending = (
        table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("buyer"))
        .agg(
            F.sum(money("o_totalprice")).cast("double").alias("total_spend_idr"),
            F.count(F.lit(1)).cast("int").alias("total_orders"),
            F.min("o_orderdate").alias("first_order"),
            F.max("o_orderdate").alias("last_order"),
        )
    )
    nations = table(spark, folder, "nation").select("n_nationkey", F.lower("n_name").alias("city"))
    user = F.col("c_custkey")
    recency = F.datediff(as_of, F.to_date("last_order"))
    chance = (user * 7919 % 1000) / 1000.0
    return (
        table(spark, folder, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(spending, user == F.col("buyer"), "left")
        .select(
            user.alias("user_id"),
            (18 + user % 50).cast("int").alias("age"),
            F.when(user % 2 == 0, " f ").otherwise("M").alias("gender"),
            "city",
            F.col("c_mktsegment").alias("user_segment"),
            "total_spend_idr",
            (F.col("total_spend_idr") / F.col("total_orders")).alias("avg_order_value_idr"),
            "total_orders",
            (F.col("total_orders") * (1 + user % 3)).cast("int").alias("total_items_purchased"),
            F.datediff(as_of, F.to_date("first_order")).alias("tenure_days"),
            recency.alias("days_since_last_purchase"),
            F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.col("c_acctbal") / 100)).alias("loyalty_score"),
            ((user % 101) / 100).alias("email_open_rate"),
            (user % 4).cast("int").alias("referral_count"),
            (user % 2).cast("int").alias("push_notif_enabled"),
            (user % 5 == 0).cast("int").alias("is_premium_member"),
            (60.0 + user % 600).alias("avg_session_duration_sec"),
            (1.0 + user % 12).alias("avg_pages_per_session"),
            F.concat(F.lit("device"), (user % 3).cast("string")).alias("preferred_device"),
            F.concat(F.lit("channel"), (user % 4).cast("string")).alias("acquisition_channel"),
            # outcomes follow the features only in part: half of what decides them is no feature
            (recency + 240.0 * chance > 300.0).cast("int").alias("is_churned"),
            (F.col("total_spend_idr") * (0.6 + 0.8 * chance)).alias("ltv_idr"),
        )
    )


def product_catalog(spark: SparkSession, folder: str) -> DataFrame:
    sales = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_partkey").alias("sold"))
        .agg(
            F.count(F.lit(1)).alias("n_sold"),
            F.sum(F.round(F.col("l_discount") * 100).cast("int")).alias("percent_sum"),
        )
    )
    part = F.col("p_partkey")
    discount = F.coalesce(6.0 * F.col("percent_sum") / F.col("n_sold"), F.lit(0.0))
    sold = F.coalesce(F.col("n_sold"), F.lit(0))
    return (
        table(spark, folder, "part")
        .join(sales, part == F.col("sold"), "left")
        .select(
            part.alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.concat(F.lit("sub"), (F.col("p_size") % 10).cast("string")).alias("subcategory"),
            F.col("p_brand").alias("brand"),
            F.col("p_retailprice").alias("base_price_idr"),
            discount.alias("discount_pct"),
            (F.col("p_retailprice") * (1 - discount / 100)).alias("final_price_idr"),
            (1.0 + F.col("p_size") % 5).alias("avg_rating"),
            F.col("p_size").cast("long").alias("review_count"),
            (part % 40).cast("int").alias("stock_quantity"),
            sold.alias("sales_last_30d"),
            (10 * sold + F.col("p_size")).alias("views_last_30d"),
            (part % 365).cast("int").alias("days_since_listed"),
            (100 + part % 900).cast("int").alias("weight_gram"),
            (part % 7 == 0).cast("int").alias("is_digital"),
            (part % 3 == 0).cast("int").alias("is_imported"),
            (sold + 20.0 * (part * 7919 % 1000) / 1000.0 > 40.0).cast("int").alias("is_trending"),
            (sold / (10 * sold + F.col("p_size"))).alias("click_through_rate"),
            (sold / (20 * sold + part % 40 + 1)).alias("conversion_rate"),
        )
    )


def product_reviews(spark: SparkSession, folder: str) -> DataFrame:
    doc = F.col("doc_id")
    labels = table(spark, folder, "labels").select(
        F.col("doc_id").alias("labelled"), "quality", "toxic"
    )
    rating = (1 + F.col("n_chars") % 6).cast("int")
    return (
        table(spark, folder, "documents")
        .join(labels, doc == F.col("labelled"), "left")
        .select(
            doc.alias("review_id"),
            (doc % 150).alias("user_id"),
            (doc % 100).alias("product_id"),
            rating.alias("rating"),
            F.col("text").alias("review_text"),
            (
                F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
                + F.make_dt_interval(hours=doc.cast("int"))
            ).alias("timestamp"),
            F.col("quality").alias("verified_purchase"),
            F.col("toxic").alias("has_photo"),
            (F.col("n_chars") % 7).cast("int").alias("helpful_votes"),
        )
    )


def search_logs(spark: SparkSession, folder: str) -> DataFrame:
    kind, k, value = F.col("event_type"), F.col("k"), F.col("value")
    clicked = F.when(kind.isin("click", "purchase"), 1).when(kind == "error", None).otherwise(0)
    return (
        table(spark, folder, "events")
        .withColumn("k", _k())
        .select(
            F.col("event_id").alias("log_id"),
            "user_id",
            F.concat(F.lit(" "), F.upper(kind), F.lit(" item "), k.cast("string"), F.lit(" ")).alias("query"),
            F.col("ts").alias("timestamp"),
            F.when(k % 3 != 0, F.concat(F.lit("c"), (k % 5).cast("string"))).alias("filter_category"),
            F.when(k % 4 != 0, value).alias("filter_min_price"),
            F.when(k % 2 != 0, value * 2).alias("filter_max_price"),
            (k % 20).cast("int").alias("n_results"),
            clicked.cast("int").alias("is_clicked"),
            (kind == "purchase").cast("int").alias("has_purchase"),
            F.when(kind.isin("click", "purchase"), 1 + k % 15)
            .when(kind == "error", None)
            .otherwise(-1)
            .cast("int")
            .alias("clicked_position"),
            F.floor(value * 10).cast("int").alias("response_time_ms"),
            kind.alias("sort_by"),
            F.concat(F.lit("p"), (k % 3).cast("string")).alias("platform"),
        )
    )


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """A scored table with many tied scores, for the evaluation queries."""
    return table(spark, folder, "events").select(
        F.col("event_id").alias("id"),
        (F.col("event_type") == "purchase").cast("int").alias("label"),
        (F.col("value") / 500).alias("score"),
        (F.col("value") > 50).cast("int").alias("prediction"),
    )


def ranked_results(spark: SparkSession, folder: str) -> DataFrame:
    """Search results with a graded relevance and a score, grouped by query."""
    logs = table(spark, folder, "events").withColumn("k", _k())
    clicked = F.col("event_type").isin("click", "purchase").cast("int")
    bought = (F.col("event_type") == "purchase").cast("int")
    return logs.select(
        F.col("event_id").alias("id"),
        F.col("k").alias("query_id"),
        (clicked + 2 * bought).alias("relevance"),
        F.col("value").alias("score"),
    )


def requests(spark: SparkSession, folder: str) -> DataFrame:
    """Request bodies; some lack the user, some are cut text, some omit ``n``."""
    k, event = F.col("k"), F.col("event_id")
    user = F.col("user_id").cast("string")
    full = F.concat(F.lit('{"user_id": '), user, F.lit(', "n": '), (1 + k % 10).cast("string"), F.lit("}"))
    body = (
        F.when(event % 17 == 0, F.concat(F.lit('{"n": '), k.cast("string"), F.lit("}")))
        .when(event % 19 == 0, F.concat(F.lit('{"user_id": '), user))
        .when(event % 5 == 0, F.concat(F.lit('{"user_id": '), user, F.lit("}")))
        .when(event % 7 == 0, F.concat(F.lit('{"user_id": "'), user, F.lit('"}')))
        .when(event % 11 == 0, F.concat(F.lit('{"user_id": "guest'), user, F.lit('"}')))
        .otherwise(full)
    )
    return (
        table(spark, folder, "events")
        .withColumn("k", _k())
        .select(event.alias("request_id"), body.alias("body"), F.col("ts").alias("requested_at"))
    )

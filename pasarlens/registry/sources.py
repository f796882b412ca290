"""Reading, writing, storing and reading back."""

from __future__ import annotations

from pyspark.sql import functions as F

from pasarlens import fixtures as fx
from pasarlens.functions import features as X
from pasarlens.operators.aggregates import interaction_matrix
from pasarlens.operators.joins import union_pairs
from pasarlens.operators.prep import encode_ids
from pasarlens.plans import etl
from pasarlens.registry.base import PC, PR, SL, TH, UI, UP, Query, ask
from pasarlens.session import staging_path
from pasarlens.sources import csv, keyed_recs, recs_store, sinks, tables
from pasarlens.streaming.ingest import ingest_new

CAP = 500


def scan_catalog(spark, folder):
    fx.table(spark, folder, "orders").createOrReplaceTempView("catalog_orders")
    return tables.dataset_summary({"catalog_orders": tables.read_table(spark, "catalog_orders")})


def _orders_as_csv(spark, folder):
    orders = fx.table(spark, folder, "orders")
    path = staging_path(spark, "csv")
    orders.repartitionByRange("o_orderkey").sortWithinPartitions("o_orderkey").write.option(
        "header", True
    ).csv(path)
    return path, orders.schema


def scan_csv_parts(spark, folder):
    path, schema = _orders_as_csv(spark, folder)
    return csv.read_csv_parts(spark, path, schema)


def scan_csv_reviews(spark, folder):
    """Free text with quotes, commas and line breaks, in parts whose columns come in another order."""
    rows = fx.product_reviews(spark, folder).select(
        "review_id", "rating", F.concat(F.lit('he said "so", '), "review_text").alias("review_text")
    )
    root = staging_path(spark, "csv")
    for name, half in (("a", rows.where("review_id % 2 = 0")), ("b", rows.where("review_id % 2 = 1").select("review_text", "rating", "review_id"))):
        half.write.option("header", True).option("escape", '"').csv(f"{root}/{name}")
    return csv.read_csv_parts(spark, f"{root}/*", rows.schema)


def row_cap(spark, folder):
    path, schema = _orders_as_csv(spark, folder)
    return csv.read_csv_parts(spark, path, schema, nrows=CAP)


def scan_parquet_pruned(spark, folder):
    return tables.read_parquet(spark, f"{folder}/lineitem.parquet", ["l_orderkey", "l_partkey"])


def dataset_summary(spark, folder):
    return tables.dataset_summary({name: getattr(fx, name)(spark, folder) for name in etl.JOBS})


def sink_partitioned(spark, folder):
    path = staging_path(spark, "sink")
    rows = fx.user_interactions(spark, folder).withColumns(X.calendar("timestamp", "month"))
    rule = etl.RULES["user_interactions"]
    sinks.write_partitioned(rows.drop("implicit_score"), path, rule.folders, rule.tasks)
    back = spark.read.parquet(path)
    return back.withColumn("interaction_type", F.col("interaction_type").cast("string"))


def incremental_ingest(spark, folder):
    """Two deliveries of files, three runs: nothing is lost or taken twice."""
    events = fx.table(spark, folder, "events")
    source, target, progress = (staging_path(spark, p) for p in ("in", "out", "progress"))
    viewed = F.col("event_type") == "view"
    for delivery in (viewed, ~viewed):
        events.where(delivery).write.mode("append").parquet(source)
        ingest_new(spark, source, target, progress, events.schema)
    ingest_new(spark, source, target, progress, events.schema)
    return spark.read.schema(events.schema).parquet(target)


def one_item_puts(spark, folder):
    return fx.user_interactions(spark, folder).select(
        F.col("user_id").cast("string").alias("user_id"),
        F.array("product_id").alias("recommendations"),
        "timestamp",
        (F.col("interaction_type") == "view").alias("viewed"),
    )


def recs_upsert(spark, folder):
    """Every event puts a one-item list for its user, in two batches; the last one stays."""
    path = staging_path(spark, "recs")
    puts = one_item_puts(spark, folder)
    for batch, mine in enumerate((puts.where("viewed"), puts.where("not viewed"))):
        recs_store.put_recs(mine, path, batch)
    return recs_store.read_recs(spark, path).withColumn(
        "recommendations", F.concat_ws(",", F.col("recommendations").cast("array<string>"))
    )


def recs_keyed(spark, folder):
    """As ``recs_upsert``, in a keyed store that is compacted and cleared of what was replaced."""
    path = staging_path(spark, "keyed")
    puts = one_item_puts(spark, folder)
    for batch, mine in enumerate((puts.where("viewed"), puts.where("not viewed"))):
        keyed_recs.put_keyed(mine, path, batch)
    keyed_recs.compact(spark, path, 2)
    keyed_recs.drop_replaced(spark, path)
    return keyed_recs.read_keyed(spark, path).withColumn(
        "recommendations", F.concat_ws(",", F.col("recommendations").cast("array<string>"))
    )


def matrix_persist(spark, folder):
    pairs = union_pairs(fx.user_interactions(spark, folder), fx.transaction_history(spark, folder))
    cells = interaction_matrix(pairs)
    encoded, _ = encode_ids(
        cells,
        {"user_id": "user_idx", "product_id": "product_idx"},
        {"user_id": ["product_id"], "product_id": ["user_id"]},
    )
    path = staging_path(spark, "matrix")
    sinks.write_matrix(encoded, path)
    return sinks.read_matrix(spark, path)


SUMMARY = " union all ".join(
    f"select '{name}' as table_name, count(*) as n_rows, cast({columns} as int) as n_columns from {name}"
    for name, columns in (
        ("user_profiles", 22),
        ("product_catalog", 20),
        ("user_interactions", 7),
        ("transaction_history", 16),
        ("product_reviews", 9),
        ("search_logs", 14),
    )
)

MATRIX_CELLS = f"""with {UI}, {TH},
cells as (
  select user_id, product_id, count(*) as n_events from (
    select user_id, product_id from user_interactions union all
    select user_id, product_id from transaction_history)
  where user_id is not null and product_id is not null group by all)
select dense_rank() over (order by user_id) - 1 as user_idx,
       dense_rank() over (order by product_id) - 1 as product_idx, n_events from cells"""

LAST_PUT = ask(
    UI,
    then="""select cast(user_id as varchar) as user_id, cast(product_id as varchar) as recommendations,
            "timestamp" from user_interactions
            qualify row_number() over (partition by user_id
              order by "timestamp" desc, interaction_type <> 'view' desc) = 1""",
)

QUERIES = [
    Query(
        "scan_catalog",
        scan_catalog,
        "select 'catalog_orders' as table_name, count(*) as n_rows, cast(6 as int) as n_columns from orders",
    ),
    Query("scan_csv_parts", scan_csv_parts, "select * from orders"),
    Query(
        "scan_csv_reviews",
        scan_csv_reviews,
        ask(PR, then="""select review_id, rating, 'he said "so", ' || review_text as review_text from product_reviews"""),
    ),
    Query("row_cap", row_cap, f"select * from orders order by o_orderkey limit {CAP}"),
    Query("scan_parquet_pruned", scan_parquet_pruned, "select l_orderkey, l_partkey from lineitem"),
    Query("dataset_summary", dataset_summary, ask(UP, PC, UI, TH, PR, SL, then=SUMMARY)),
    Query(
        "sink_partitioned",
        sink_partitioned,
        ask(
            UI,
            then="""select * exclude (implicit_score), cast(month("timestamp") as int) as month
                    from user_interactions""",
        ),
    ),
    Query("incremental_ingest", incremental_ingest, "select * from events"),
    Query(
        "recs_upsert",
        recs_upsert,
        LAST_PUT,
    ),
    Query("recs_keyed", recs_keyed, LAST_PUT),
    Query("matrix_persist", matrix_persist, MATRIX_CELLS),
]

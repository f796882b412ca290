"""Answering a stream of recommendation requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pasarlens.operators.recommend import answer_requests, parse_requests
from pasarlens.session import stage
from pasarlens.sources.keyed_recs import look_up
from pasarlens.sources.recs_store import put_recs
from pasarlens.operators.topk import topk

REQUEST_SCHEMA = "request_id long, body string, requested_at timestamp_ntz"


def items_of(answers: DataFrame) -> DataFrame:
    """The items to store: one per successful user of the batch, the latest request."""
    good = answers.where("status = 200").select(
        F.col("user_id"),
        F.col("recommendations"),
        F.col("requested_at").alias("timestamp"),
        "request_id",
    )
    return topk(good, ["user_id"], [F.desc("timestamp"), F.desc("request_id")], 1, "_rank").drop("_rank")


def answer_from_store(requests: DataFrame, path: str, as_of: str) -> DataFrame:
    """Answer requests from a keyed store, of which only the buckets of the asked users are opened."""
    asked = parse_requests(requests).where("status = 200").select("user_id")
    lists = stage(look_up(requests.sparkSession, path, asked), "lists")
    return answer_requests(requests, lists.select("user_id", "recommendations"), as_of)


def serve_stream(
    spark: SparkSession, source: str, lists: DataFrame | str, responses: str, store: str, progress: str, as_of: str
) -> None:
    """Answer all new request files, write responses and put the served lists.

    ``lists`` is a table, or the path of a keyed store that every batch looks its users up in.
    Each micro-batch is answered by the batch job, and both outputs are folders named
    after the batch, so a batch that runs again replaces its own output.
    """

    def answer(batch: DataFrame, number: int) -> None:
        known = isinstance(lists, str)
        answers = answer_from_store(batch, lists, as_of) if known else answer_requests(batch, lists, as_of)
        path = f"{responses}/batch={number}"
        answers.write.mode("overwrite").parquet(path)
        written = batch.sparkSession.read.schema(answers.schema).parquet(path)
        put_recs(items_of(written), store, number)

    query = (
        spark.readStream.schema(REQUEST_SCHEMA)
        .parquet(source)
        .writeStream.foreachBatch(answer)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()

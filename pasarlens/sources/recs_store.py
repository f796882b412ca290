"""Stored recommendations: a log of puts of which the last per user counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def last_per_user(puts: DataFrame) -> DataFrame:
    """The newest put of every user (ties: the later batch); skew-safe rank limit."""
    newest = Window.partitionBy("user_id").orderBy(F.desc("timestamp"), F.desc("batch"))
    return puts.withColumn("_age", F.row_number().over(newest)).where("_age = 1").drop("_age")


def put_recs(items: DataFrame, path: str, batch: int) -> None:
    """Append one batch of {user_id, recommendations, timestamp}.

    The batch has its own folder that is overwritten as a whole, so a repeated batch
    leaves the same content, and no earlier data is read or rewritten.
    """
    items.select("user_id", "recommendations", "timestamp").write.mode("overwrite").parquet(
        f"{path}/batch={batch}"
    )


def read_recs(spark: SparkSession, path: str) -> DataFrame:
    """The stored item of every user."""
    return last_per_user(spark.read.parquet(path)).select("user_id", "recommendations", "timestamp")


def compact_recs(spark: SparkSession, path: str, target: str) -> None:
    """Write the current items as the first batch of a new store."""
    put_recs(read_recs(spark, path), target, 0)


def upsert_recs(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old items with the new ones put over them; the last timestamp per user wins."""
    both = old.withColumn("batch", F.lit(0)).unionByName(new.withColumn("batch", F.lit(1)))
    return last_per_user(both).drop("batch")

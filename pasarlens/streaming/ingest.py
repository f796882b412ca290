"""Incremental ingest: only files that no earlier run has taken in."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def ingest_new(
    spark: SparkSession,
    source: str,
    target: str,
    progress: str,
    schema: StructType | str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    source_format: str = "parquet",
) -> None:
    """Append what is new under ``source`` to ``target`` and return when caught up.

    ``progress`` remembers the files taken in; a rerun adds nothing twice.  The target
    grows, it is never replaced by the last increment.
    """
    fresh = spark.readStream.schema(schema).format(source_format).load(source)
    rows = transform(fresh) if transform else fresh
    query = (
        rows.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .outputMode("append")
        .start()
    )
    query.awaitTermination()

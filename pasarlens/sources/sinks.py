"""Writing result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows per output file at most; a big partition value gets several files.
ROWS_PER_FILE = 5_000_000


def write_partitioned(
    df: DataFrame, path: str, by: Sequence[str] | None = None, tasks: int | None = None
) -> None:
    """Overwrite ``path`` with snappy Parquet in folders per value of ``by``.

    The rebalance step brings rows of a folder together, so a folder gets few files, and
    lets adaptive execution split a folder that holds a large share of the rows.
    ``tasks`` is the number of shuffle partitions to start from.
    """
    spread = [*([tasks] if tasks else []), *[F.col(c) for c in by or []]]
    writer = (
        df.hint("rebalance", *spread)
        .write.mode("overwrite")
        .option("compression", "snappy")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
    )
    if by:
        writer = writer.partitionBy(*by)
    writer.parquet(path)


def write_matrix(matrix: DataFrame, path: str) -> None:
    """Interaction matrix as (user_idx, product_idx, n_events), in ranges of users.

    Ranges use both indices, so a user with very many cells does not fill one file, and
    the sort lets a reader of one user skip all other row groups.
    """
    (
        matrix.select("user_idx", "product_idx", "n_events")
        .repartitionByRange("user_idx", "product_idx")
        .sortWithinPartitions("user_idx", "product_idx")
        .write.mode("overwrite")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .parquet(path)
    )


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("user_idx long, product_idx long, n_events long").parquet(path)

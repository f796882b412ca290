"""Input tables and table summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, name: str, database: str | None = None) -> DataFrame:
    """A table of the catalog."""
    return spark.table(f"{database}.{name}" if database else name)


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows while the job runs, instead of running a job to count them."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def dataset_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Name, rows and columns of every table (row counts come from file footers)."""
    lines = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns")
        )
        for name, df in tables.items()
    ]
    summary = lines[0]
    for line in lines[1:]:
        summary = summary.unionByName(line)
    return summary

"""Sorted and top-k results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def topk(
    df: DataFrame, part: Sequence[str], order: Sequence[Column | str], k: int, rank: str = "rank"
) -> DataFrame:
    """First ``k`` rows per group.

    The rank limit lets each task keep only its own ``k`` best rows per group before the
    shuffle, so a hot group costs ``k`` rows per task.
    """
    best_first = Window.partitionBy(*part).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(best_first)).where(F.col(rank) <= k)


def top_n(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """First ``n`` rows of the whole table."""
    return df.orderBy(*order).limit(n)


def sort_desc(df: DataFrame, column: str, tie: str) -> DataFrame:
    return df.orderBy(F.desc(column), tie)


def head_n(df: DataFrame, key: str, n: int) -> DataFrame:
    return df.orderBy(key).limit(n)

"""Cleaning steps shared by the table jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pasarlens.functions.features import parse_timestamp
from pasarlens.session import stage

# Up to so many keys with copies are sent to all tasks.
REPEATED_KEYS = 1_000_000


def dedup(df: DataFrame, key: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the first by ``order_by`` (default: all other columns).

    Rows with a null key form one group.  The rank filter lets every task keep only its
    best copy before the shuffle, so a key with very many copies does not travel.
    """
    order = list(order_by) if order_by else [c for c in df.columns if c not in key]
    first = Window.partitionBy(*key).orderBy(*(order or key))
    return df.withColumn("_copy", F.row_number().over(first)).where("_copy = 1").drop("_copy")


def staged_dedup(
    df: DataFrame, key: Sequence[str], label: str, order_by: Sequence[str] | None = None, most: int | None = None
) -> DataFrame:
    """As ``dedup``, on a stored copy of the rows: only the keys and the rows that have copies are moved.

    With more than ``most`` keys that have copies all rows are ranked, as in ``dedup``.
    """
    rows = stage(df, label, codec="zstd")
    counted = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_copies")).where("_copies > 1")
    repeated = stage(counted.select(*[F.col(k).alias(f"_key_{k}") for k in key]), "repeated")
    n = repeated.count()
    if not n:
        return rows
    if n > (REPEATED_KEYS if most is None else most):
        return stage(dedup(rows, key, order_by), label, codec="zstd")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in key])
    mine = F.broadcast(repeated)
    first = stage(dedup(rows.join(mine, same, "left_semi"), key, order_by), label, codec="zstd")
    return rows.join(mine, same, "left_anti").unionByName(first)


def drop_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without null in the listed columns (default: in any column)."""
    return df.dropna("any", subset=list(columns) if columns else None)


def basic_clean(
    df: DataFrame,
    key: Sequence[str],
    not_null: Sequence[str],
    order_by: Sequence[str] | None = None,
    nulls_first: bool = False,
) -> DataFrame:
    """Deduplicate, then drop rows with missing required values.

    A bad copy can displace a good one in this order; ``nulls_first`` swaps the steps.
    """
    if nulls_first:
        return dedup(drop_nulls(df, not_null), key, order_by)
    return drop_nulls(dedup(df, key, order_by), not_null)


def observed_clean(
    df: DataFrame, key: Sequence[str], not_null: Sequence[str], order_by: Sequence[str] | None = None
) -> tuple[DataFrame, Observation, Observation]:
    """As ``basic_clean``, with row counts before and after taken while the job runs."""
    before, after = Observation("rows_before"), Observation("rows_after")
    counted = df.observe(before, F.count(F.lit(1)).alias("rows"))
    cleaned = basic_clean(counted, key, not_null, order_by)
    return cleaned.observe(after, F.count(F.lit(1)).alias("rows")), before, after


def clean_report(df: DataFrame, key: Sequence[str], not_null: Sequence[str], name: str) -> DataFrame:
    """Rows before, after and dropped, as one row.

    A key survives if its first copy has the required values; counting needs no copy of
    the rows themselves, only one small aggregate per key.
    """
    order = [c for c in df.columns if c not in key]
    complete = F.lit(True)
    for column in not_null:
        complete = complete & F.col(column).isNotNull()
    cleaned = dedup(df, key, order).agg(F.count_if(complete).alias("rows_after"))
    raw = df.agg(F.count(F.lit(1)).alias("rows_before"))
    return cleaned.select(
        F.lit(name).alias("table_name"),
        raw.scalar().alias("rows_before"),
        "rows_after",
        (raw.scalar() - F.col("rows_after")).alias("rows_dropped"),
    )


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast; a value that does not fit becomes null instead of failing the job.

    Text such as ``12.5`` becomes 12 in a whole-number column.
    """

    def cast(name: str, kind: str) -> Column:
        column = F.col(name)
        text = isinstance(df.schema[name].dataType, T.StringType)
        if text and kind in ("int", "long", "bigint"):
            return F.coalesce(column.try_cast(kind), column.try_cast("double").try_cast(kind))
        return column.try_cast(kind)

    return df.withColumns({name: cast(name, kind) for name, kind in types.items()})


def parse_time(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Text becomes a wall-clock timestamp; a typed column is kept."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return df.withColumn(column, parse_timestamp(F.col(column)))
    return df


def positive(df: DataFrame, amount: str) -> DataFrame:
    return df.where(F.col(amount) > 0)


def between(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return df.where(F.col(column).between(low, high))


def equals(df: DataFrame, column: str, value: object) -> DataFrame:
    return df.where(F.col(column) == F.lit(value))

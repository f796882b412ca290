"""Per-key statistics on every row, without sending a hot key to one task.

``count(*) over (partition by user)`` moves all rows of a user into one task.  Here the
statistics are aggregated first (map-side combine shrinks a hot key to one row per task)
and joined back.  Keys that hold a large share of the rows are found from their counts;
their rows are spread over several slices and their one statistics row is repeated once
per slice, so the join stays balanced and its result is the same.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pasarlens.session import stage

# A key is hot if it holds more than 1/HOT_SHARE of the rows.  Shares add up to one, so
# there are fewer than HOT_SHARE hot keys: that is the size bound of the broadcast below.
HOT_SHARE = 10_000
# Below this many rows a key is no burden for one task, whatever its share.
HOT_ROWS = 500_000


def shuffle_width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def join_stats(
    rows: DataFrame,
    stats: DataFrame,
    keys: Sequence[str],
    size: str,
    spread_by: Sequence[str],
    null_safe: bool = False,
    how: str = "left",
    hot_rows: int | None = None,
    ready: bool = False,
    null_keys: bool = False,
) -> DataFrame:
    """Join ``stats`` (one row per key) to ``rows``.

    ``size`` is the column of ``stats`` with the number of rows a key has in ``rows``.
    ``spread_by`` are columns of ``rows`` that differ within a key (usually the row id).
    ``null_safe`` lets null keys match each other, as a window partition would.
    ``ready`` says that ``stats`` is a stored table; otherwise it is stored first, because
    it is read for its largest key, for its hot keys and for the join.
    ``null_keys``: many rows of a left join may have no key; they are spread as well.
    """
    table = stats if ready else stage(stats, "stats")
    total, largest = table.agg(F.sum(size), F.max(size)).first()
    limit = max(HOT_ROWS if hot_rows is None else hot_rows, (total or 0) // HOT_SHARE)
    spread = F.lit(False)
    sliced = rows

    def same(prefix: str) -> Column:
        pairs = [
            F.col(k).eqNullSafe(F.col(prefix + k)) if null_safe else F.col(k) == F.col(prefix + k)
            for k in keys
        ]
        return reduce(lambda a, b: a & b, pairs)

    hot = F.col(size) > limit
    any_hot = (largest or 0) > limit
    if any_hot:
        marked = table.where(hot).select(
            *[F.col(k).alias(f"_hot_{k}") for k in keys], F.lit(True).alias("_hot")
        )
        sliced = sliced.join(F.broadcast(marked), same("_hot_"), "left")
        spread = F.coalesce("_hot", spread)
    if null_keys:
        spread = spread | reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    right = table.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys], *[c for c in table.columns if c not in keys]
    )
    if not (any_hot or null_keys):
        return rows.join(right, same("_key_"), how).drop(*[f"_key_{k}" for k in keys])

    width = shuffle_width(rows)
    own_slice = F.pmod(F.xxhash64(*spread_by), F.lit(width)).cast("int")
    sliced = sliced.withColumn("_slice", F.when(spread, own_slice).otherwise(F.lit(0))).drop(
        "_hot", *[f"_hot_{k}" for k in keys]
    )
    copies = F.when(hot, F.sequence(F.lit(0), F.lit(width - 1))).otherwise(F.array(F.lit(0)))
    repeated = right.withColumn("_copy", F.explode(copies))
    joined = sliced.join(repeated, same("_key_") & (F.col("_slice") == F.col("_copy")), how)
    return joined.drop("_slice", "_copy", *[f"_key_{k}" for k in keys])


def with_group_stats(
    rows: DataFrame,
    keys: Sequence[str],
    aggregates: dict[str, Column],
    spread_by: Sequence[str],
    null_safe: bool = False,
    hot_rows: int | None = None,
) -> DataFrame:
    """Every row plus the named aggregates of its group."""
    stats = rows.groupBy(*keys).agg(
        *[c.alias(name) for name, c in aggregates.items()], F.count(F.lit(1)).alias("_size")
    )
    return join_stats(rows, stats, keys, "_size", spread_by, null_safe, "left", hot_rows).drop("_size")


def largest_group(rows: DataFrame, keys: Sequence[str]) -> int:
    """Rows in the biggest group (one map-side combined aggregate, one number back)."""
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.max("n")).first()[0] or 0

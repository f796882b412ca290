"""Global and per-group order without a single-task sort.

Three tools, all exact:

* ``rank_cuts``     the values that stand at given ranks, found by counting passes;
* ``global_position``  the 0-based place of every row in one total order;
* ``rank_in_group`` / ``ntile_in_group``  row_number and ntile per group, with another
  way for groups too big for one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pasarlens.operators.skew import join_stats, largest_group
from pasarlens.session import stage

# Groups up to this size are ranked by an ordinary window.
WINDOW_ROWS = 5_000_000
# percentile_approx keeps at most about this many centroids; its rank error is rows/ACCURACY.
ACCURACY = 1_000
# The digests of the tasks are merged in so many groups: no task merges those of all others.
DIGEST_GROUPS = 64
# Once all search windows together hold this few rows, their values are fetched.
FINISH_ROWS = 20_000


# ------------------------------------------------------------------ order statistics


@dataclass
class _Search:
    """Search for the value at ``rank`` among the ``size`` rows that satisfy ``rows``."""

    rows: Column
    rank: int
    size: int
    above: Any = None  # the value is known to be > above, with `passed` rows up to there ...
    below: Any = None  # ... and < below
    passed: int = 0
    value: Any = None
    equal: int = 0

    def inside(self, column: Column) -> Column:
        condition = self.rows & column.isNotNull()
        if self.above is not None:
            condition = condition & (column > F.lit(self.above))
        if self.below is not None:
            condition = condition & (column < F.lit(self.below))
        return condition

    def probes(self) -> list[float]:
        exact = (self.rank - self.passed + 0.5) / self.size
        slack = 2.0 / ACCURACY
        return [max(exact - slack, 0.0), exact, min(exact + slack, 1.0)]

    def window(self) -> tuple:
        return id(self.rows), self.above, self.below

    def found(self, value: Any, smaller: int, equal: int) -> None:
        self.value, self.equal, self.rank = value, equal, self.rank - smaller

    def narrow(self, counted: list[tuple[Any, int, int]]) -> None:
        """Move the window by exact counts (value, rows between it and the value before, equal rows)."""
        end = self.passed + self.size
        smaller = self.passed
        for value, between, equal in counted:
            smaller += between
            if self.rank < smaller:
                self.below, end = value, smaller
                break
            if self.rank < smaller + equal:
                self.found(value, smaller, equal)
                return
            smaller += equal
            self.above, self.passed = value, smaller
        self.size = end - self.passed


def _pivots(df: DataFrame, column: Column, windows: list[list[_Search]]) -> list[list[Any]]:
    """A few values of every window close to the wanted ranks (the ends keep it moving).

    Every group of tasks gives its own estimate, and the middle one is taken: pivots need not be
    exact, as the rows between them are counted exactly.
    """
    picks = []
    for i, group in enumerate(windows):
        inside = F.when(group[0].inside(column), column)
        wanted = [p for s in group for p in s.probes()]
        picks += [
            F.percentile_approx(inside, wanted, ACCURACY).alias(f"p{i}"),
            F.min(inside).alias(f"lo{i}"),
            F.max(inside).alias(f"hi{i}"),
        ]
    found = df.groupBy(F.pmod(F.spark_partition_id(), F.lit(DIGEST_GROUPS)).alias("_tasks")).agg(*picks).collect()
    pivots = []
    for i in range(len(windows)):
        seen = [r for r in found if r[f"lo{i}"] is not None]
        middle = {sorted(values)[len(values) // 2] for values in zip(*[r[f"p{i}"] for r in seen])}
        pivots.append(sorted({*middle, min(r[f"lo{i}"] for r in seen), max(r[f"hi{i}"] for r in seen)}))
    return pivots


def _count_pivots(
    df: DataFrame, column: Column, windows: list[list[_Search]], pivots: list[list[Any]]
) -> list[list[tuple[Any, int, int]]]:
    """Exact counts at and between the pivots of every window, in one aggregate.

    A row is counted under its window, the number of pivots it has reached, and whether
    it equals one of them.
    """
    case = None
    for i, group in enumerate(windows):
        values = F.array(*[F.lit(v) for v in pivots[i]])
        reached = F.array_size(F.filter(values, lambda p: p <= column))
        place = F.struct(
            F.lit(i).alias("i"), reached.alias("j"), F.array_contains(values, column).alias("hit")
        )
        case = (F if case is None else case).when(group[0].inside(column), place)
    counts = df.select(case.alias("at")).where("at is not null").groupBy("at.i", "at.j", "at.hit").count()
    seen = {(r["i"], r["j"], r["hit"]): r["count"] for r in counts.collect()}
    return [
        [(v, seen.get((i, j, False), 0), seen.get((i, j + 1, True), 0)) for j, v in enumerate(values)]
        for i, values in enumerate(pivots)
    ]


def _select(df: DataFrame, column: Column, searches: list[_Search]) -> None:
    """Run all searches together; every round is two aggregates with small results."""
    pending = [s for s in searches if s.value is None]
    while pending:
        if sum(s.size for s in pending) <= FINISH_ROWS:
            _finish(df, column, pending)
            return
        shared: dict[tuple, list[_Search]] = {}
        for search in pending:
            shared.setdefault(search.window(), []).append(search)
        windows = list(shared.values())
        counted = _count_pivots(df, column, windows, _pivots(df, column, windows))
        for group, counts in zip(windows, counted):
            for search in group:
                search.narrow(counts)
        pending = [s for s in pending if s.value is None]


def _finish(df: DataFrame, column: Column, searches: list[_Search]) -> None:
    """Fetch the few values left in the windows (FINISH_ROWS at most) and read off the ranks."""
    marks = F.array(*[F.when(s.inside(column), F.lit(i)) for i, s in enumerate(searches)])
    left = (
        df.select(column.alias("v"), F.explode(F.array_compact(marks)).alias("i"))
        .groupBy("i", "v")
        .count()
        .collect()
    )
    for i, search in enumerate(searches):
        smaller = search.passed
        for value, rows in sorted((r["v"], r["count"]) for r in left if r["i"] == i):
            if search.rank < smaller + rows:
                search.found(value, smaller, rows)
                break
            smaller += rows


@dataclass
class Cut:
    """First row of a new section in the order (value nulls first, then key)."""

    value: Any
    key: Any

    def reached(self, value: Column, key: Column) -> Column:
        if self.value is None:
            return value.isNotNull() | (key >= F.lit(self.key))
        later = value > F.lit(self.value)
        same = value == F.lit(self.value)
        if self.key is not None:
            same = same & (key >= F.lit(self.key))
        return F.coalesce(later | same, F.lit(False))


def tie_number(df: DataFrame, key: str) -> Column:
    """A number per key that orders ties: the key itself, or its hash if it is not a number."""
    kind = df.schema[key].dataType
    if isinstance(kind, T.IntegralType):
        return F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)).cast("long"))
    return F.xxhash64(key)


def rank_cuts(
    df: DataFrame, v: Column, k: Column, targets: Sequence[tuple[Column, int]]
) -> list[Cut]:
    """The rows at 0-based ``rank`` of the order (value ``v`` nulls first, key ``k``), per target.

    A target is (row condition, rank).  Both are numbers, and the key is unique and not
    null within equal values.  Only counts and candidate values reach the driver, a fixed
    number per target, and no row is shuffled.
    """
    conditions: dict[int, Column] = {id(rows): rows for rows, _ in targets}
    sizes = df.agg(
        *[F.count_if(rows).alias(f"n{i}") for i, rows in conditions.items()],
        *[F.count_if(rows & v.isNull()).alias(f"z{i}") for i, rows in conditions.items()],
    ).first()
    # Searches among the same rows must share one condition object (see _Search.window).
    among: dict[tuple, Column] = {}
    in_nulls: list[_Search | None] = []
    searches: list[_Search | None] = []
    for rows, rank in targets:
        nulls, size = sizes[f"z{id(rows)}"], sizes[f"n{id(rows)}"]
        if not 0 <= rank < size:
            raise ValueError(f"rank {rank} is outside 0..{size - 1}")
        without_value = among.setdefault((id(rows), None), rows & v.isNull())
        in_nulls.append(_Search(without_value, rank, nulls) if rank < nulls else None)
        searches.append(None if rank < nulls else _Search(rows, rank - nulls, size - nulls))
    _select(df, v, [s for s in searches if s])
    ties: list[_Search | None] = []
    for null_side, search in zip(in_nulls, searches):
        if null_side:
            ties.append(null_side)
        elif search.equal > 1 and search.rank > 0:
            tied = (id(search.rows), search.value)
            same = among.setdefault(tied, search.rows & (v == F.lit(search.value)))
            ties.append(_Search(same, search.rank, search.equal))
        else:
            ties.append(None)
    _select(df, k, [t for t in ties if t])
    for tie in ties:
        if tie and tie.equal > 1:
            raise ValueError("the key must be unique within equal values")
    return [
        Cut(search.value if search else None, tie.value if tie else None)
        for search, tie in zip(searches, ties)
    ]


def _tile_starts(rows: int, tiles: int) -> list[int]:
    """0-based ranks at which tiles 2, 3, ... begin; the first tiles are the larger ones."""
    small, larger = divmod(rows, tiles)
    starts = [t * small + min(t, larger) for t in range(1, tiles)]
    return [s for s in starts if s < rows]


def global_ntile(
    df: DataFrame, tiles: int, value: str, key: str, name: str, measured: DataFrame | None = None
) -> DataFrame:
    """``ntile(tiles)`` over all rows by (value, key).

    Only the ``tiles - 1`` borders are searched; a row's tile then is a comparison with
    literals, so the wide rows are never moved.  ``measured`` may give the same
    (value, key) pairs from a cheaper place.
    """
    narrow = (measured if measured is not None else df).select(value, key)
    rows = narrow.count()
    everything = F.lit(True)
    v, k = F.col(value), tie_number(df, key)
    if isinstance(df.schema[value].dataType, (T.DoubleType, T.FloatType)):
        v = F.nanvl(v, F.lit(float("inf")))  # not-a-number counts as the largest value
    targets = [(everything, rank) for rank in _tile_starts(rows, tiles)]
    cuts = rank_cuts(narrow, v, k, targets) if targets else []
    tile = reduce(
        lambda below, cut: F.when(cut[1].reached(v, k), cut[0]).otherwise(below),
        enumerate(cuts, start=2),
        F.lit(1),
    )
    return df.withColumn(name, tile.cast("int"))


# ------------------------------------------------------------------ positions


def global_position(df: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """0-based place of every row in the total order of ``order``.

    Range partitioning puts rows in order across tasks (ties are split because ``order``
    ends in a unique column); the place within a task is written out with the row, so it
    cannot change if a task runs again.  The per-task offsets are one number per shuffle
    partition.
    """
    in_task = (1 << 33) - 1
    placed = stage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_task", F.shiftright("_at", 33).cast("int"))
        .withColumn("_at", F.col("_at").bitwiseAND(F.lit(in_task))),
        "position",
    )
    sizes = placed.groupBy("_task").count().collect()  # one row per shuffle partition
    offsets, total = [], 0
    for task, rows in sorted((r["_task"], r["count"]) for r in sizes):
        offsets.append((task, total))
        total += rows
    starts = df.sparkSession.createDataFrame(offsets, "_task int, _start long")
    return (
        placed.join(F.broadcast(starts), "_task", "left")
        .withColumn(name, F.col("_start") + F.col("_at"))
        .drop("_task", "_at", "_start")
    )


def running_total(df: DataFrame, order: str, amounts: Sequence[str]) -> DataFrame:
    """Add ``cum_<amount>``: the sum of each amount over all rows up to and with this one.

    ``order`` is unique.  Sums inside a range partition are a window; what comes before
    the partition is one row per shuffle partition.
    """
    placed = stage(
        df.repartitionByRange(order).withColumn("_task", F.spark_partition_id()), "running"
    )
    sums = placed.groupBy("_task").agg(*[F.sum(a).alias(a) for a in amounts]).collect()
    so_far = [0] * len(amounts)
    offsets = []
    for row in sorted(sums, key=lambda r: r["_task"]):
        offsets.append((row["_task"], *so_far))
        so_far = [t + row[a] for t, a in zip(so_far, amounts)]
    fields = ", ".join(["_task int", *[f"_before_{a} long" for a in amounts]])
    before = df.sparkSession.createDataFrame(offsets, fields)
    upto = Window.partitionBy("_task").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    summed = placed.join(F.broadcast(before), "_task", "left")
    for a in amounts:
        summed = summed.withColumn(f"cum_{a}", F.col(f"_before_{a}") + F.sum(a).over(upto))
    return summed.drop("_task", *[f"_before_{a}" for a in amounts])


# ------------------------------------------------------------------ ranks inside groups


def _ranked(
    df: DataFrame, group: Sequence[str], order: Sequence[str], key: str, window_rows: int | None
) -> DataFrame:
    """Add ``_rank`` (0-based) and ``_group_rows``."""
    limit = WINDOW_ROWS if window_rows is None else window_rows
    if largest_group(df, group) <= limit:
        within = Window.partitionBy(*group)
        return df.withColumn(
            "_rank", (F.row_number().over(within.orderBy(*order, key)) - 1).cast("long")
        ).withColumn("_group_rows", F.count(F.lit(1)).over(within))
    columns = list(dict.fromkeys([*group, *order, key]))
    placed = global_position(df.select(*columns), list(dict.fromkeys([*group, *order, key])), "_place")
    starts = placed.groupBy(*group).agg(
        F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_group_rows")
    )
    ranks = join_stats(placed, starts, group, "_group_rows", [key], null_safe=True).select(
        F.col(key).alias("_ranked_key"),
        (F.col("_place") - F.col("_first")).alias("_rank"),
        "_group_rows",
    )
    return df.join(ranks, F.col(key).eqNullSafe(F.col("_ranked_key")), "left").drop("_ranked_key")


def rank_in_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    key: str,
    name: str,
    window_rows: int | None = None,
) -> DataFrame:
    """``row_number()`` by (order, key) within group; ``key`` is unique in ``df``."""
    ranked = _ranked(df, group, order, key, window_rows)
    return ranked.withColumn(name, (F.col("_rank") + 1).cast("int")).drop("_rank", "_group_rows")


def ntile_in_group(
    df: DataFrame,
    tiles: int,
    group: Sequence[str],
    order: Sequence[str],
    key: str,
    name: str,
    window_rows: int | None = None,
) -> DataFrame:
    """``ntile(tiles)`` by (order, key) within group; ``key`` is unique in ``df``."""
    ranked = _ranked(df, group, order, key, window_rows)
    small = F.floor(F.col("_group_rows") / F.lit(tiles)).cast("long")
    larger = F.col("_group_rows") % F.lit(tiles)
    in_larger = larger * (small + 1)
    tile = F.when(
        F.col("_rank") < in_larger, F.floor(F.col("_rank") / (small + 1)) + 1
    ).otherwise(larger + F.floor((F.col("_rank") - in_larger) / F.greatest(small, F.lit(1))) + 1)
    return ranked.withColumn(name, tile.cast("int")).drop("_rank", "_group_rows")

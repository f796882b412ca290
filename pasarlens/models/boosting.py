"""Second-order boosted trees on histograms, for any objective with gradients and Hessians.

The rows are put into quantile bins once.  A row is a list of cells (feature, bin); the bin that
holds the value zero is left out, so sparse text vectors stay sparse.  In every round the tasks
add the last trees to the margins of their rows and take gradients and Hessians from the objective.  A
tree then grows level by level: the tasks sum gradients by open leaf and cell, the sums of a leaf
and feature meet in one partition, and only the best split per leaf and partition reaches the
driver.  The trees of all classes of a round grow together in the same passes.

A table of at most ``TASK_CELLS`` values, or two thirds as many cells of many features, is one partition and needs no
passes: its task takes all rounds, moves rows one level at a time and sums the smaller child of a split
only; the other child is the rest of its parent.  With few features it holds a byte per value, feature
by feature, with many the cells of the rows.  Where it is large and its executor has more cores, processes of
the task share it (``team``): by rows if it has few features, by features if it has many.  All ways run the same steps.

The gain of a split is that of the regularised Newton step,

    T(G)^2 / (H + l2) of both sides, less that of the leaf,      T(G) = G moved towards 0 by l1,

and a leaf's value is -step * T(G) / (H + l2).  The leaves that gain most are split first until the
tree has ``leaves`` of them; leaves of one level are judged together.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator, Sequence
from itertools import chain
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pasarlens.models.objectives import Objective, objective_of
from pasarlens.models.team import Team
from pasarlens.operators.skew import shuffle_width
from pasarlens.session import stage

# Cells that a partition of the training rows holds where the table has many.
PART_CELLS = 4_000_000
# What one task holds, values of few features (a byte each); up to here passes over partitions take longer.
# It is two thirds for cells of many features, and for a search, whose trainings run side by side.
TASK_CELLS = 96_000_000
# So many values of few features, or cells of many, are worth one more process of the task; so many processes at most.
HELPER_CELLS = 1_000_000, 500_000
MOST_HELPERS = 8
# Rounds between two written states; what is cached in between can be computed again from the last one.
STAGE_ROUNDS = 20
# Rows that such a task sums at a time: they stay in the processor's cache.
CACHE_ROWS = 16_384
# Bins that several features may have together, and sums of a level: so many stay in the cache.
JOINT_BINS = (16_384, 2_048, 256)
JOINT_CELLS = 32_768
# Up to so many features, rows keep their bins as a matrix.
DENSE_FEATURES = 64
TRAINED = pa.schema([("number", pa.int32()), ("body", pa.string()), ("train", pa.float64()), ("held", pa.float64())])
ROW = "uid long, query long, y double, w double, held boolean, entries array<int>"
STATE = f"{ROW}, margins array<double>, g array<double>, h array<double>, drawn boolean, loss double, loss_w double"


@dataclass(frozen=True)
class Params:
    """Size and regularisation; ``rows`` and ``columns`` are the shares that a tree draws."""

    rounds: int = 400
    depth: int = 6
    leaves: int = 63
    step: float = 0.05
    rows: float = 1.0
    columns: float = 1.0
    l1: float = 0.0
    l2: float = 1.0
    min_gain: float = 0.0
    min_weight: float = 1e-3
    min_rows: int = 1
    bins: int = 64
    patience: int = 50
    seed: int = 42


@dataclass
class Tree:
    """Nodes as lists; a leaf has feature -1.  Rows with bin <= ``cut`` go left."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, gain: float) -> int:
        """The left child's number; the right child is the next one."""
        self.feature[node], self.cut[node], self.gain[node], self.left[node] = feature, cut, gain, len(self.feature)
        self.value[node] = 0.0
        for column, empty in ((self.feature, -1), (self.cut, 0), (self.left, 0), (self.value, 0.0), (self.gain, 0.0)):
            column += [empty, empty]
        return self.left[node]

    def levels(self) -> int:
        level = [0] * len(self.feature)
        for node, feature in enumerate(self.feature):  # children have higher numbers
            if feature >= 0:
                level[self.left[node]] = level[self.left[node] + 1] = level[node] + 1
        return max(level)


# ------------------------------------------------------------------ bins


@dataclass
class Bins:
    """Cut points per feature; a value's bin is the number of cut points below it."""

    cuts: list[list[float]]

    def __post_init__(self):
        sizes = np.array([len(c) + 1 for c in self.cuts], np.int64)
        self.first = np.cumsum(sizes) - sizes
        self.cells = int(sizes.sum())
        self.feature_of = np.repeat(np.arange(len(sizes)), sizes)
        self.zero = np.array([np.searchsorted(c, 0.0, side="left") for c in self.cuts], np.int64)

    def entries(self, index: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Cells of (feature, value) pairs."""
        out = np.zeros(len(index), np.int64)
        order = np.argsort(index, kind="stable")
        edges = np.searchsorted(index[order], np.arange(len(self.cuts) + 1))
        for f in np.flatnonzero(np.diff(edges)):
            mine = order[edges[f] : edges[f + 1]]
            out[mine] = self.first[f] + np.searchsorted(self.cuts[f], values[mine], side="left")
        return out


def nonzero(features: str = "features") -> Column:
    """(i, x) of the entries of a vector that are not zero."""
    pairs = F.transform(vector_to_array(features), lambda x, i: F.struct(i.alias("i"), x.alias("x")))
    return F.filter(pairs, lambda p: p["x"] != 0)


def fit_bins(rows: DataFrame, n_features: int, most: int) -> Bins:
    """Quantiles of the values that are not zero, and zero itself; ``rows`` has ``pairs``."""
    shares = [k / most for k in range(1, most)]
    found = (
        rows.select(F.explode("pairs").alias("p"))
        .groupBy("p.i")
        .agg(F.percentile_approx("p.x", shares, 10_000).alias("q"), F.max("p.x").alias("high"), F.count(F.lit(1)).alias("n"))
        .collect()  # one row per feature
    )
    n_rows = rows.count()
    cuts: list[list[float]] = [[] for _ in range(n_features)]
    for r in found:
        points = set(r["q"]) | ({0.0} if r["n"] < n_rows else set())
        cuts[r["i"]] = sorted(p for p in points if p < max(r["high"], 0.0 if r["n"] < n_rows else r["high"]))
    return Bins(cuts)


# ------------------------------------------------------------------ rows in a task


class Rows:
    """A batch of binned rows."""

    def __init__(self, entries: pa.Array, bins: Bins):
        self.bins = bins
        self.flat = entries.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        self.sizes = np.diff(entries.offsets.to_numpy())
        self.row = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.feature = bins.feature_of[self.flat]
        self.dense = self.matrix() if len(bins.cuts) <= DENSE_FEATURES else None

    def matrix(self) -> np.ndarray:
        """All bins, (features, rows)."""
        bins = self.bins
        most = max((len(c) for c in bins.cuts), default=0)
        start = bins.zero.astype(np.uint8 if most < 255 else np.uint16 if most < 65_535 else np.int64)
        out = np.repeat(start[:, None], len(self.sizes), axis=1)
        out[self.feature, self.row] = self.flat - bins.first[self.feature]
        return out

    def columns_of(self, used: np.ndarray) -> np.ndarray:
        """Bins of a few features, (rows, features)."""
        at = np.full(len(self.bins.cuts), -1)
        at[used] = np.arange(len(used))
        out = np.tile(self.bins.zero[used], (len(self.sizes), 1))
        column = at[self.feature]
        mine = column >= 0
        out[self.row[mine], column[mine]] = self.flat[mine] - self.bins.first[used[column[mine]]]
        return out

    def nodes(self, trees: Sequence[Tree]) -> list[np.ndarray]:
        """The node of every tree in which each row ends."""
        if self.dense is not None:
            return [walked(self.dense, t) for t in trees]
        used = np.unique([f for t in trees for f in t.feature if f >= 0]).astype(int)
        values = self.columns_of(used)
        found = []
        for t in trees:
            feature, cut, left = np.array(t.feature), np.array(t.cut), np.array(t.left)
            column = np.searchsorted(used, np.maximum(feature, 0)) if len(used) else feature
            node = np.zeros(len(self.sizes), np.int64)
            while True:
                inner = np.flatnonzero(feature[node] >= 0)
                if not len(inner):
                    break
                at = node[inner]
                node[inner] = left[at] + (values[inner, column[at]] > cut[at])
            found.append(node)
        return found


def stepped(dense: np.ndarray, node: np.ndarray, tree: Tree, first: int = 0) -> np.ndarray:
    """The nodes of the rows from ``first`` on, one level further down; a row in a leaf stays."""
    n = dense.shape[1]
    inner = np.array(tree.feature) >= 0
    start = np.where(inner, tree.feature, 0) * n
    # no bin lies above the last one, so a leaf sends all rows to its "left", itself
    cut = np.where(inner, tree.cut, np.iinfo(dense.dtype).max).astype(dense.dtype)
    left = np.where(inner, tree.left, np.arange(len(inner)))
    at = start.take(node)
    at += np.arange(first, first + len(node))
    right = dense.reshape(-1).take(at) > cut.take(node)
    return left.take(node) + right


def walked(dense: np.ndarray, tree: Tree) -> np.ndarray:
    node = np.zeros(dense.shape[1], np.int64)
    for _ in range(tree.levels()):
        node = stepped(dense, node, tree)
    return node


def lists(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def as_lists(values: np.ndarray) -> pa.Array:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * width, width), pa.int32()), pa.array(values.reshape(-1)))


def drawn(uid: np.ndarray, tree: int, share: float, seed: int) -> np.ndarray:
    """Whether a row belongs to the sample of a tree; the same whenever a task runs again."""
    if share >= 1:
        return np.ones(len(uid), bool)
    x = uid.astype(np.uint64) + np.uint64((seed * 1_000_003 + tree) * 0x9E3779B97F4A7C15 % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)).astype(float) / (1 << 53) < share


def advance(parts: Iterator[pa.RecordBatch], trees: Sequence[Tree], bins: Bins, base: Sequence[float]) -> Iterator[pa.RecordBatch]:
    """Rows with the margins after these trees (of one round); without margins yet, those of the start."""
    for batch in parts:
        if not batch.num_rows:
            continue
        names = batch.schema.names
        if "margins" in names:
            margins = lists(batch.column("margins"), len(base)).copy()
        else:
            margins = np.tile(np.array(base, float), (batch.num_rows, 1))
        if trees:
            for k, (tree, node) in enumerate(zip(trees, Rows(batch.column("entries"), bins).nodes(trees))):
                margins[:, k] += np.array(tree.value)[node]
        kept = ["uid", "query", "y", "w", "held", "entries"]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], as_lists(margins)], [*kept, "margins"])


def with_gradients(parts: Iterator[pa.RecordBatch], objective: Objective, tree: int, params: Params, context: object) -> Iterator[pa.RecordBatch]:
    """Rows with gradient, Hessian and loss; ``drawn`` marks the sample of the next trees."""
    for batch in objective.batches(parts):
        column = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("uid", "query", "y", "w", "held")}
        margins = lists(batch.column("margins"), objective.width)
        g, h, loss, loss_w = objective.gradients(margins, column, context)
        mine = drawn(column["uid"], tree, params.rows, params.seed) & ~column["held"].astype(bool)
        names = ["uid", "query", "y", "w", "held", "entries", "margins"]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in names], as_lists(g), as_lists(h), pa.array(mine), pa.array(loss), pa.array(loss_w)],
            [*names, "g", "h", "drawn", "loss", "loss_w"],
        )


CELLS = "segment long, bin int, g double, h double, n double"
SPLITS = "leaf long, feature int, cut int, gain double, g double, h double, n double"


@dataclass
class Leaves:
    """The open leaves of all trees of a level, numbered through: node numbers and sums."""

    slots: list[dict[int, int]]  # per tree: node -> number
    totals: np.ndarray  # (leaves, 3): G, H, rows
    allowed: list[np.ndarray]  # per tree: features it may use


Search = Callable[[list[Tree], Leaves], Sequence]


def cells_of_rows(
    rows: Rows, drawn: np.ndarray, g: np.ndarray, h: np.ndarray, trees: Sequence[Tree], leaves: Leaves
) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of (open leaf, cell), and the sums of gradient, Hessian and rows drawn in each."""
    bins, found = rows.bins, []
    for k, node in enumerate(rows.nodes(trees)):
        slot = np.full(len(trees[k].feature), -1)
        for at, number in leaves.slots[k].items():
            slot[at] = number
        leaf = np.where(drawn, slot[node], -1)
        use = (leaf >= 0)[rows.row]
        if not leaves.allowed[k].all():
            use &= leaves.allowed[k][rows.feature]
        row, cell = (rows.row, rows.flat) if use.all() else (rows.row[use], rows.flat[use])
        if not len(row):
            continue
        first, size = min(leaves.slots[k].values()) * bins.cells, len(leaves.slots[k]) * bins.cells
        at = leaf[row] * bins.cells + cell - first
        if size <= 4 * len(at):
            count = np.bincount(at, minlength=size)
            kept = np.flatnonzero(count)
            sums = [np.bincount(at, v[row, k], minlength=size)[kept] for v in (g, h)] + [count[kept].astype(float)]
        else:
            kept, place, count = np.unique(at, return_inverse=True, return_counts=True)
            sums = [np.bincount(place, v[row, k], minlength=len(kept)) for v in (g, h)] + [count.astype(float)]
        found.append((kept + first, np.stack(sums)))
    if not found:
        return np.zeros(0, np.int64), np.zeros((3, 0))
    # the open leaves of a tree are numbered in a row, so no number is found twice
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found], axis=1)


def cell_batch(at: np.ndarray, sums: np.ndarray, bins: Bins) -> pa.RecordBatch:
    leaf, cell = at // bins.cells, at % bins.cells
    feature = bins.feature_of[cell]
    columns = [pa.array(leaf * len(bins.cuts) + feature), pa.array((cell - bins.first[feature]).astype(np.int32))]
    return pa.RecordBatch.from_arrays([*columns, *[pa.array(s) for s in sums]], ["segment", "bin", "g", "h", "n"])


def cells_of(parts: Iterator[pa.RecordBatch], trees: Sequence[Tree], leaves: Leaves, bins: Bins) -> Iterator[pa.RecordBatch]:
    """The sums of the cells, batch by batch; those of all batches of a task are added up."""
    numbers, sums = np.zeros(0, np.int64), np.zeros((3, 0))
    for batch in parts:
        drawn = batch.column("drawn").to_numpy(zero_copy_only=False).astype(bool)
        g, h = (lists(batch.column(c), len(trees)) for c in ("g", "h"))
        more, add = cells_of_rows(Rows(batch.column("entries"), bins), drawn, g, h, trees, leaves)
        both, place = np.unique(np.r_[numbers, more], return_inverse=True)
        sums = np.stack([np.bincount(place, np.r_[a, b], minlength=len(both)) for a, b in zip(sums, add)])
        numbers = both
    if len(numbers):
        yield cell_batch(numbers, sums, bins)


def shrunk(g: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def score(g: np.ndarray, h: np.ndarray, params: Params) -> np.ndarray:
    return shrunk(g, params.l1) ** 2 / np.maximum(h + params.l2, 1e-300)


def best_splits(parts: Iterator[pa.RecordBatch], leaves: Leaves, bins: Bins, params: Params) -> Iterator[pa.RecordBatch]:
    """The best split of every leaf among the features of this partition (whole segments)."""
    table = [b for b in parts if b.num_rows]
    if not table:
        return
    segment, bin_, g, h, n = (np.concatenate([b.column(c).to_numpy() for b in table]) for c in ("segment", "bin", "g", "h", "n"))
    n_features = len(bins.cuts)
    sums = np.stack([g, h, n])
    most = int(bin_.max()) + 2 + int(bins.zero.max(initial=0))
    key = segment * most + bin_
    if len(key) > 1 and not (key[1:] > key[:-1]).all():
        # sums in one order, so that they do not depend on the order of arrival
        order = np.lexsort((h, g, key))
        segment, bin_, sums = segment[order], bin_[order], sums[:, order]
    starts = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
    # what a leaf has beyond its listed cells lies in the bin of zero
    which = segment[starts]
    rest = leaves.totals[which // n_features].T - np.add.reduceat(sums, starts, axis=1)
    rest[2] = np.round(rest[2])
    segment, bin_ = np.r_[segment, which], np.r_[bin_, bins.zero[which % n_features]]
    sums = np.concatenate([sums, np.where(rest[2] > 0, rest, 0.0)], axis=1)
    order = np.argsort(segment * most + bin_, kind="stable")
    segment, bin_, sums = segment[order], bin_[order], sums[:, order]
    starts = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
    sizes = np.diff(np.append(starts, len(segment)))
    upto = np.cumsum(sums, axis=1)
    left = upto - np.repeat(upto[:, starts] - sums[:, starts], sizes, axis=1)
    leaf = segment // n_features
    total = leaves.totals[leaf].T
    right = total - left
    gain = score(left[0], left[1], params) + score(right[0], right[1], params) - score(total[0], total[1], params)
    last = np.r_[(segment[1:] == segment[:-1]) & (bin_[1:] == bin_[:-1]), False]  # the bin goes on
    good = ~last & (np.minimum(left[2], right[2]) >= max(params.min_rows, 1) - 0.5)
    good &= (np.minimum(left[1], right[1]) >= params.min_weight) & (gain > max(params.min_gain, 1e-12))
    at = np.flatnonzero(good)
    # 32 bits of a gain count: what differs by rounding alone is a tie, and the first feature wins it
    unit = 2.0 ** (np.ceil(np.log2(gain[at])) - 32)
    gain[at] = np.round(gain[at] / unit) * unit
    order = at[np.lexsort((bin_[at], segment[at], -gain[at], leaf[at]))]
    first = order[np.flatnonzero(np.r_[True, leaf[order][1:] != leaf[order][:-1]])] if len(order) else order
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(leaf[first]), pa.array((segment[first] % n_features).astype(np.int32)), pa.array(bin_[first].astype(np.int32)),
            pa.array(gain[first]), *[pa.array(left[i][first]) for i in range(3)],
        ],
        ["leaf", "feature", "cut", "gain", "g", "h", "n"],
    )


# ------------------------------------------------------------------ growing


def grown(search: Search, totals: Sequence[tuple[float, float, float]], bins: Bins, params: Params, number: int) -> list[Tree]:
    """The trees of one round, one per margin, grown together; ``search`` finds the best splits of a level."""
    chance = np.random.default_rng([params.seed, number])
    n_features = len(bins.cuts)
    trees = [Tree() for _ in totals]
    allowed = []
    for _ in trees:
        mask = np.zeros(n_features, bool)
        mask[chance.choice(n_features, max(1, round(params.columns * n_features)), replace=False)] = True
        allowed.append(mask)
    sums = [{0: np.array(t, float)} for t in totals]
    open_ = [(k, 0) for k in range(len(trees))]
    for _ in range(params.depth):
        if not open_:
            break
        slots: list[dict[int, int]] = [{} for _ in trees]
        open_.sort()
        for at, (k, node) in enumerate(open_):
            slots[k][node] = at
        best: dict[int, tuple] = {}
        for r in search(trees, Leaves(slots, np.array([sums[k][node] for k, node in open_]), allowed)):
            rank = (-r["gain"], r["feature"], r["cut"])
            if r["leaf"] not in best or rank < best[r["leaf"]][0]:
                best[r["leaf"]] = (rank, r)
        split = []
        for _, r in sorted(best.values(), key=lambda x: (x[0], x[1]["leaf"])):
            k, node = open_[r["leaf"]]
            if (len(trees[k].feature) + 1) // 2 >= params.leaves:
                continue
            left = trees[k].split(node, r["feature"], r["cut"], r["gain"])
            whole, part = sums[k].pop(node), np.array([r["g"], r["h"], r["n"]])
            sums[k] |= {left: part, left + 1: whole - part}
            split += [(k, left), (k, left + 1)]
        open_ = split
    for k, tree in enumerate(trees):
        for node, (g, h, _) in sums[k].items():
            tree.value[node] = float(-params.step * shrunk(np.array(g), params.l1) / max(h + params.l2, 1e-300))
    return trees


class InSpark:
    """The rows of a training in many partitions: every step is a pass over them."""

    def __init__(self, table: DataFrame, bins: Bins, base: Sequence[float], objective: Objective, params: Params, hot: list, parts: int):
        self.state, self.bins, self.base, self.objective, self.params, self.hot, self.parts = table, bins, base, objective, params, hot, parts
        self.cached: list[DataFrame] = []

    def kept(self, df: DataFrame) -> DataFrame:
        self.cached.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return self.cached[-1]

    def advance(self, last: list[Tree], number: int) -> tuple[list, float | None, float | None]:
        """Margins, gradients and losses after the last trees; sums of the rows drawn, and both losses."""
        bins, base, objective, params = self.bins, self.base, self.objective, self.params
        before, self.cached = self.cached, []
        if self.hot:
            moved = self.kept(self.state.mapInArrow(lambda b: advance(b, last, bins, base), f"{ROW}, margins array<double>"))
            context = objective.context(moved, self.hot)
            step = moved.mapInArrow(lambda b: with_gradients(b, objective, number, params, context), STATE)
        else:
            step = self.state.mapInArrow(lambda b: with_gradients(advance(b, last, bins, base), objective, number, params, None), STATE)
        if number and number % STAGE_ROUNDS == 0:
            step = stage(step, "boosting")
        self.state = self.kept(step)
        sums = [F.sum(F.when(F.col("drawn"), F.col(c)[k])).alias(f"{c}{k}") for k in range(objective.width) for c in ("g", "h")]
        losses = [
            F.sum(F.when(F.col("held") == flag, F.col(c))).alias(f"{c}_{name}")
            for c in ("loss", "loss_w")
            for flag, name in ((False, "train"), (True, "held"))
        ]
        seen = self.state.agg(*sums, F.count_if("drawn").alias("n"), *losses).first()
        for old in before:
            old.unpersist()
        totals = [(seen[f"g{k}"], seen[f"h{k}"], float(seen["n"])) for k in range(objective.width)] if seen["n"] else []
        return totals, *[seen[f"loss_{x}"] / seen[f"loss_w_{x}"] if seen[f"loss_w_{x}"] else None for x in ("train", "held")]

    def search(self, trees: list[Tree], leaves: Leaves) -> list:
        bins, params = self.bins, self.params
        cells = self.state.mapInArrow(lambda b: cells_of(b, trees, leaves, bins), CELLS)
        found = cells.repartition(self.parts, "segment").mapInArrow(lambda b: best_splits(b, leaves, bins, params), SPLITS)
        return found.collect()  # one row per open leaf and partition

    def close(self) -> None:
        for old in self.cached:
            old.unpersist()


class InTask:
    """The rows of a training that is one partition, level by level from the root: the plain way, which the faster two are held against."""

    def __init__(self, parts: Iterator[pa.RecordBatch], bins: Bins, base: Sequence[float], objective: Objective, params: Params):
        batch = pa.concat_batches([b for b in parts if b.num_rows])
        self.rows, self.bins, self.objective, self.params = Rows(batch.column("entries"), bins), bins, objective, params
        self.column = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("uid", "query", "y", "w", "held")}
        self.held = self.column["held"].astype(bool)
        self.margins = np.tile(np.array(base, float), (batch.num_rows, 1))

    def advance(self, last: list[Tree], number: int) -> tuple[list, float | None, float | None]:
        if last:
            for k, (tree, node) in enumerate(zip(last, self.rows.nodes(last))):
                self.margins[:, k] += np.array(tree.value)[node]
        self.g, self.h, loss, loss_w = self.objective.gradients(self.margins, self.column, None)
        self.drawn = drawn(self.column["uid"], number, self.params.rows, self.params.seed) & ~self.held
        losses = []
        for some in (~self.held, self.held):
            weight = loss_w[some].sum()
            losses.append(float(loss[some].sum() / weight) if weight else None)
        n = float(self.drawn.sum())
        sums = zip(self.g[self.drawn].sum(axis=0), self.h[self.drawn].sum(axis=0))
        return [(a, b, n) for a, b in sums] if n else [], *losses

    def search(self, trees: list[Tree], leaves: Leaves) -> list:
        cells = cell_batch(*cells_of_rows(self.rows, self.drawn, self.g, self.h, trees, leaves), self.bins)
        return [r for b in best_splits(iter([cells]), leaves, self.bins, self.params) for r in b.to_pylist()]


class InColumns:
    """As ``InTask``, for few features: their bins lie in columns and the rows keep their nodes between levels.

    A sum over rows costs the same for one feature as for the joint bins of several, and the sums of each of
    them follow from those of the joint bins.  So features are joined as far as the sums of a level stay in
    the processor's cache: the fewer leaves are summed, the more features share a pass over the rows.
    """

    def __init__(self, parts: Iterator[pa.RecordBatch], bins: Bins, base: Sequence[float], objective: Objective, params: Params):
        self.bins, self.objective, self.params = bins, objective, params
        names, found, columns = ("uid", "query", "y", "w", "held"), [], []
        for batch in parts:
            if batch.num_rows:
                found.append(Rows(batch.column("entries"), bins).dense)
                columns.append([batch.column(c).to_numpy(zero_copy_only=False).copy() for c in names])
        self.dense = np.concatenate(found, axis=1)
        self.column = {c: np.concatenate(x) for c, x in zip(names, zip(*columns))}
        self.held = self.column["held"].astype(bool)
        self.sides = np.flatnonzero(~self.held), np.flatnonzero(self.held)
        self.margins = np.tile(np.array(base, float), (len(self.held), 1))
        self.most = max((len(c) for c in bins.cuts), default=0) + 1
        self.joined: dict[int, list[tuple]] = {}
        self.fresh()

    def fresh(self) -> None:
        """Back to the roots."""
        self.node = [np.zeros(len(self.held), np.int64) for _ in range(self.margins.shape[1])]
        self.sums: list[tuple] = [()] * self.margins.shape[1]  # per tree: numbers of the last level's leaves, and their cells

    def advance(self, last: list[Tree], number: int) -> tuple[list, float | None, float | None]:
        sums, width = self.moved(last, number), self.objective.width
        n = float(sums[2 * width])
        losses = [float(loss / weight) if weight else None for loss, weight in sums[2 * width + 1 :].reshape(2, 2)]
        return [(sums[k], sums[width + k], n) for k in range(width)] if n else [], *losses

    def moved(self, last: list[Tree], number: int) -> np.ndarray:
        """The rows after the last trees: sums of gradients, Hessians and number of those drawn, then of both losses and their weights."""
        for k, tree in enumerate(last):
            self.step(k, tree)
            self.margins[:, k] += np.array(tree.value).take(self.node[k])
        self.fresh()
        g, h, loss, loss_w = self.objective.gradients(self.margins, self.column, None)
        self.g, self.h = (np.asfortranarray(x) for x in (g, h))
        self.even = bool((self.h == 1.0).all())
        self.drawn = drawn(self.column["uid"], number, self.params.rows, self.params.seed) & ~self.held
        mine = np.flatnonzero(self.drawn)
        losses = [x.take(some).sum() for some in self.sides for x in (loss, loss_w)]
        return np.concatenate([self.g[mine].sum(axis=0), self.h[mine].sum(axis=0), [len(mine)], losses])

    def step(self, k: int, tree: Tree) -> None:
        """The nodes of the rows one level further down."""
        if len(tree.feature) > 1:
            for a in range(0, len(self.held), CACHE_ROWS):
                some = slice(a, a + CACHE_ROWS)
                self.node[k][some] = stepped(self.dense, self.node[k][some], tree, a)

    def groups(self, leaves: int) -> list[tuple]:
        """Features that are summed together over so many leaves: their numbers, numbers of bins, and joint bins of the rows."""
        room = next((r for r in JOINT_BINS if r * leaves <= JOINT_CELLS and 4 * r * leaves <= len(self.held)), 1)
        if room not in self.joined:
            sizes = [len(c) + 1 for c in self.bins.cuts]
            found: list[list[int]] = []
            for f in sorted(range(len(sizes)), key=lambda f: -sizes[f]):  # the largest first, each where it leaves least room
                fits = [x for x in found if sizes[f] * int(np.prod([sizes[i] for i in x])) <= room]
                if fits:
                    max(fits, key=lambda x: int(np.prod([sizes[i] for i in x]))).append(f)
                else:
                    found.append([f])
            self.joined[room] = []
            for x in found:
                joint = self.dense[x[0]]
                for f in x[1:]:
                    joint = joint.astype(np.uint16) * np.uint16(sizes[f]) + self.dense[f]
                self.joined[room].append((x, [sizes[f] for f in x], joint))
        return self.joined[room]

    def cells(self, k: int, small: dict[int, int], allowed: np.ndarray, size: int) -> np.ndarray:
        """Sums of gradient, Hessian and rows drawn, (3, features, nodes, bins), of the nodes in ``small`` (node -> place)."""
        place = np.full(size, -1)
        place[list(small)] = list(small.values())
        groups = [x for x in self.groups(len(small)) if allowed[x[0]].any()]
        widths = [int(np.prod(sizes)) for _, sizes, _ in groups]
        tables = [np.zeros((3, len(small) * width)) for width in widths]
        rows = max(CACHE_ROWS, 4 * len(small) * max(widths, default=0))
        for a in range(0, len(self.held), rows):
            some = slice(a, a + rows)
            at = place.take(self.node[k][some])
            use = np.flatnonzero((at >= 0) & self.drawn[some])
            start, g, h = at.take(use), self.g[some, k].take(use), self.h[some, k].take(use)
            for (_, _, joint), width, table in zip(groups, widths, tables):
                key = joint[some].take(use) + start * width
                count = np.bincount(key, minlength=table.shape[1])
                table[0] += np.bincount(key, g, minlength=table.shape[1])
                table[1] += count if self.even else np.bincount(key, h, minlength=table.shape[1])
                table[2] += count
        out = np.zeros((3, len(self.bins.cuts), len(small), self.most))
        for (features, sizes, _), table in zip(groups, tables):
            joint = table.reshape(3, len(small), *sizes)
            for i, f in enumerate(features):
                if allowed[f]:
                    others = tuple(j + 2 for j in range(len(features)) if j != i)
                    out[:, f, :, : sizes[i]] = joint.sum(axis=others)
        return out

    def search(self, trees: list[Tree], leaves: Leaves) -> list:
        found = []
        for k, tree in enumerate(trees):
            numbers = leaves.slots[k]
            self.step(k, tree)
            if not numbers:
                continue
            first = min(numbers.values())  # the open leaves of a tree are numbered in a row
            totals = leaves.totals[first : first + len(numbers)]
            if 0 in numbers:
                sums = self.cells(k, {0: 0}, leaves.allowed[k], len(tree.feature))
            else:
                before, above = self.sums[k]
                pairs = [(before[p], left) for p, left in enumerate(tree.left) if tree.feature[p] >= 0 and left in numbers]
                smaller = {}
                for i, (_, left) in enumerate(pairs):
                    a, b = (totals[numbers[x] - first, 2] for x in (left, left + 1))
                    smaller[left if a <= b else left + 1] = i
                part = self.cells(k, smaller, leaves.allowed[k], len(tree.feature))
                rest = above[:, :, [p for p, _ in pairs]] - part
                rest[:, rest[2] < 0.5] = 0.0  # what is left of the sums of an empty cell is rounding
                sums = np.empty((*part.shape[:2], len(numbers), self.most))
                for node, i in smaller.items():
                    other = node + 1 if node % 2 else node - 1  # a left child has an odd number
                    sums[:, :, numbers[node] - first], sums[:, :, numbers[other] - first] = part[:, :, i], rest[:, :, i]
            self.sums[k] = ({node: at - first for node, at in numbers.items()}, sums)
            found += best_cells(sums, totals, first, self.params)
        return found


class SharedColumns(InColumns):
    """As ``InColumns``, the rows dealt to processes of the task: what they sum is added up."""

    def __init__(self, parts: Iterator[pa.RecordBatch], bins: Bins, base: Sequence[float], objective: Objective, params: Params, helpers: int):
        self.bins, self.objective, self.params = bins, objective, params
        self.most = max((len(c) for c in bins.cuts), default=0) + 1
        self.team = Team(helpers, lambda number, batches: InColumns(batches, bins, base, objective, params))
        self.team.given(parts, dealt=True)

    def moved(self, last: list[Tree], number: int) -> np.ndarray:
        self.sums = [()] * self.objective.width
        return sum(self.team.each("moved", last, number))

    def step(self, k: int, tree: Tree) -> None:
        if len(tree.feature) > 1:
            self.team.each("step", k, tree)

    def cells(self, k: int, small: dict[int, int], allowed: np.ndarray, size: int) -> np.ndarray:
        return sum(self.team.each("cells", k, small, allowed, size))

    def close(self) -> None:
        self.team.close()


class InCells:
    """As ``InTask``, for many features: rows lie by leaf, and only the smaller child of a split is summed.

    A leaf keeps the cells of those features that can still split it: what lies outside the bin of zero is
    all on one side of that bin's cuts, so a feature with fewer such rows than ``min_rows`` splits neither
    the leaf nor what grows from it.
    """

    def __init__(self, parts: Iterator[pa.RecordBatch], bins: Bins, base: Sequence[float], objective: Objective, params: Params):
        self.bins, self.objective, self.params = bins, objective, params
        table = [b for b in parts if b.num_rows]
        entries = [b.column("entries") for b in table]
        self.flat = np.concatenate([e.flatten().to_numpy(zero_copy_only=False) for e in entries]).astype(np.int32, copy=False)
        sizes = np.concatenate([np.diff(e.offsets.to_numpy()) for e in entries]).astype(np.int64)
        self.start = np.concatenate([[0], np.cumsum(sizes)])
        names = ("uid", "query", "y", "w", "held")
        self.column = {c: np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in table]) for c in names}
        self.held = self.column["held"].astype(bool)
        self.margins = np.tile(np.array(base, float), (len(self.held), 1))
        # the cells once more, feature by feature: a split asks for one feature
        order = np.argsort(self.flat, kind="stable")
        self.by_cell, self.row_of = self.flat[order], np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[order]
        self.edge = np.searchsorted(self.by_cell, np.append(bins.first, bins.cells))
        self.zero = bins.first + bins.zero
        self.fresh()

    def fresh(self) -> None:
        """Back to the roots."""
        width = self.margins.shape[1]
        self.rows: list[dict[int, np.ndarray]] = [{0: np.arange(len(self.held))} for _ in range(width)]
        self.sums: list[dict[int, tuple]] = [{} for _ in range(width)]  # per tree: open leaf -> its cells and their sums
        self.level = 0

    def step(self, k: int, tree: Tree) -> None:
        """The rows of the leaves that were split go to the children."""
        for node in [x for x in self.rows[k] if tree.feature[x] >= 0]:
            side = self.side(k, node, tree.feature[node], tree.cut[node])
            mine = self.rows[k].pop(node)
            self.rows[k][tree.left[node]], self.rows[k][tree.left[node] + 1] = mine[~side], mine[side]

    def side(self, k: int, node: int, feature: int, cut: int) -> np.ndarray:
        """Which rows of a leaf go right at a split."""
        right = np.full(len(self.held), self.bins.zero[feature] > cut)
        some = slice(self.edge[feature], self.edge[feature + 1])
        right[self.row_of[some]] = self.by_cell[some] - self.bins.first[feature] > cut
        return right[self.rows[k][node]]

    def advance(self, last: list[Tree], number: int) -> tuple[list, float | None, float | None]:
        for k, tree in enumerate(last):
            self.step(k, tree)
            for node, mine in self.rows[k].items():
                self.margins[mine, k] += tree.value[node]
        self.fresh()
        g, h, loss, loss_w = self.objective.gradients(self.margins, self.column, None)
        self.g, self.h = (np.asfortranarray(x) for x in (g, h))
        self.drawn = drawn(self.column["uid"], number, self.params.rows, self.params.seed) & ~self.held
        losses = []
        for some in (~self.held, self.held):
            weight = loss_w[some].sum()
            losses.append(float(loss[some].sum() / weight) if weight else None)
        n = float(self.drawn.sum())
        sums = zip(self.g[self.drawn].sum(axis=0), self.h[self.drawn].sum(axis=0))
        return [(a, b, n) for a, b in sums] if n else [], *losses

    def cells(self, k: int, node: int) -> np.ndarray:
        """Sums of gradient, Hessian and rows drawn of a leaf, (3, cells)."""
        mine = self.rows[k][node]
        mine = mine[self.drawn[mine]]
        out = np.zeros((3, self.bins.cells))
        upto = np.cumsum(self.start[mine + 1] - self.start[mine])
        a = 0
        while a < len(mine):
            # batches of cells that stay in the processor's cache
            z = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + 8 * CACHE_ROWS, side="right")))
            rows = mine[a:z]
            first, sizes = self.start[rows], self.start[rows + 1] - self.start[rows]
            if rows[-1] - rows[0] == len(rows) - 1:
                cell = self.flat[first[0] : first[-1] + sizes[-1]]
            else:
                cell = self.flat[np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]
            for i, weight in enumerate((self.g, self.h)):
                out[i] += np.bincount(cell, np.repeat(weight[rows, k], sizes), minlength=self.bins.cells)
            out[2] += np.bincount(cell, minlength=self.bins.cells)
            a = z
        return out

    def kept(self, cell: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cells of the features that can still split, and their sums."""
        if not len(cell):
            return cell, sums
        feature = self.bins.feature_of[cell]
        starts = np.flatnonzero(np.r_[True, feature[1:] != feature[:-1]])
        enough = np.add.reduceat(sums[2], starts) >= max(self.params.min_rows, 1) - 0.5
        if enough.all():
            return cell, sums
        use = np.repeat(enough, np.diff(np.append(starts, len(cell))))
        return cell[use], sums[:, use]

    def search(self, trees: list[Tree], leaves: Leaves) -> list:
        found = []
        for k, tree in enumerate(trees):
            self.step(k, tree)
            numbers, before, self.sums[k] = leaves.slots[k], self.sums[k], {}
            now: dict[int, tuple] = {}
            if 0 in numbers:
                cell = np.flatnonzero(leaves.allowed[k][self.bins.feature_of])
                sums = self.cells(k, 0)
                now[0] = self.kept(cell, sums if len(cell) == self.bins.cells else sums[:, cell])
            else:
                for parent, (cell, above) in before.items():
                    left = tree.left[parent]
                    if tree.feature[parent] < 0 or left not in numbers:
                        continue
                    a, b = (leaves.totals[numbers[x], 2] for x in (left, left + 1))
                    small, large = (left, left + 1) if a <= b else (left + 1, left)
                    part = self.cells(k, small)[:, cell]
                    rest = above - part
                    rest[:, rest[2] < 0.5] = 0.0  # what is left of the sums of an empty cell is rounding
                    now[small], now[large] = self.kept(cell, part), self.kept(cell, rest)
            for node, number in numbers.items():
                found += self.best(*now[node], leaves.totals[number], number)
            if self.level + 1 < self.params.depth:
                self.sums[k] = now
        self.level += 1
        return found

    def best(self, cell: np.ndarray, sums: np.ndarray, total: np.ndarray, number: int) -> list[dict]:
        """The best split of a leaf by the rules of ``best_splits``."""
        params, least = self.params, max(self.params.min_rows, 1) - 0.5
        if not len(cell) or total[2] < 2 * least:
            return []
        feature = self.bins.feature_of[cell]
        starts = np.flatnonzero(np.r_[True, feature[1:] != feature[:-1]])
        # what a leaf has beyond its listed cells lies in the bin of zero
        zero = np.searchsorted(cell, self.zero[feature[starts]])
        rest = total[:, None] - np.add.reduceat(sums, starts, axis=1)
        rest[2] = np.round(rest[2])
        sums[:, zero] = np.where(rest[2] > 0, rest, 0.0)
        use = np.flatnonzero(sums[2] > 0.5)
        filled, feature = sums[:, use], feature[use]
        sums[:, zero] = 0.0  # as before, for the children
        # every feature starts again from nothing, so the sums stay as exact as those of one feature
        starts = np.flatnonzero(feature[1:] != feature[:-1]) + 1
        filled[:, starts] -= total[:, None]
        g, h, rows = np.cumsum(filled, axis=1)
        at = np.flatnonzero(np.minimum(rows, total[2] - rows) >= least)
        g, h, rows = g[at], h[at], rows[at]
        gain = score(g, h, params) + score(total[0] - g, total[1] - h, params) - score(total[0], total[1], params)
        good = np.flatnonzero((np.minimum(h, total[1] - h) >= params.min_weight) & (gain > max(params.min_gain, 1e-12)))
        if not len(good):
            return []
        gain = gain[good]
        unit = 2.0 ** (np.ceil(np.log2(gain)) - 32)
        gain = np.round(gain / unit) * unit
        top = int(np.argmax(gain))  # of equal ones the first feature and cut
        i = good[top]
        f = int(feature[at[i]])
        cut = int(cell[use[at[i]]] - self.bins.first[f])
        return [{"leaf": number, "feature": f, "cut": cut, "gain": float(gain[top]), "g": float(g[i]), "h": float(h[i]), "n": float(rows[i])}]


class PartOfCells(InCells):
    """Every ``count``-th feature of all rows.  The side of a row at a split is told by the part that has the feature."""

    def __init__(
        self, parts: Iterator[pa.RecordBatch], bins: Bins, base: Sequence[float], objective: Objective, params: Params, number: int, count: int
    ):
        self.features = np.arange(number, len(bins.cuts), count)
        own = Bins([bins.cuts[f] for f in self.features])
        self.place = np.full(len(bins.cuts), -1)
        self.place[self.features] = np.arange(len(self.features))
        shift = np.zeros(len(bins.cuts), np.int64)
        shift[self.features] = own.first - bins.first[self.features]

        def only(batch: pa.RecordBatch) -> pa.RecordBatch:
            entries = batch.column("entries")
            flat, offsets = entries.flatten().to_numpy(zero_copy_only=False), entries.offsets.to_numpy()
            feature = bins.feature_of[flat]
            keep = self.place[feature] >= 0
            upto = np.concatenate([[0], np.cumsum(keep)])
            cells = pa.array((flat + shift[feature])[keep].astype(np.int32))
            mine = pa.ListArray.from_arrays(pa.array(upto[offsets - offsets[0]], pa.int32()), cells)
            names = ["uid", "query", "y", "w", "held"]
            return pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], mine], [*names, "entries"])

        super().__init__((only(b) for b in parts), own, base, objective, params)

    def sides(self, trees: Sequence[Tree]) -> dict[tuple[int, int], np.ndarray]:
        """(tree, leaf) -> which of its rows go right, a bit each, for the leaves that were split by an own feature."""
        return {
            (k, node): np.packbits(InCells.side(self, k, node, self.place[tree.feature[node]], tree.cut[node]))
            for k, tree in enumerate(trees)
            for node in self.rows[k]
            if tree.feature[node] >= 0 and self.place[tree.feature[node]] >= 0
        }

    def side(self, k: int, node: int, feature: int, cut: int) -> np.ndarray:
        return np.unpackbits(self.told[k, node], count=len(self.rows[k][node])).astype(bool)

    def moved(self, told: dict[tuple[int, int], np.ndarray], last: list[Tree], number: int) -> tuple[list, float | None, float | None]:
        self.told = told
        return self.advance(last, number)

    def found(self, told: dict[tuple[int, int], np.ndarray], trees: list[Tree], leaves: Leaves) -> list[dict]:
        self.told = told
        best = self.search(trees, Leaves(leaves.slots, leaves.totals, [a[self.features] for a in leaves.allowed]))
        return [{**r, "feature": int(self.features[r["feature"]])} for r in best]


class SharedCells:
    """As ``InCells``, the features dealt to processes of the task: each finds the best splits of its own."""

    def __init__(self, parts: Iterator[pa.RecordBatch], bins: Bins, base: Sequence[float], objective: Objective, params: Params, helpers: int):
        self.team = Team(helpers, lambda number, batches: PartOfCells(batches, bins, base, objective, params, number, helpers))
        self.team.given(parts, dealt=False)

    def sides(self, trees: Sequence[Tree]) -> dict[tuple[int, int], np.ndarray]:
        split = any(len(t.feature) > 1 for t in trees)
        return {at: side for found in self.team.each("sides", trees) for at, side in found.items()} if split else {}

    def advance(self, last: list[Tree], number: int) -> tuple[list, float | None, float | None]:
        return self.team.each("moved", self.sides(last), last, number)[0]  # all have all rows

    def search(self, trees: list[Tree], leaves: Leaves) -> list:
        return [r for found in self.team.each("found", self.sides(trees), trees, leaves) for r in found]

    def close(self) -> None:
        self.team.close()


def best_cells(sums: np.ndarray, totals: np.ndarray, first: int, params: Params) -> list[dict]:
    """The best split of every leaf from the sums of all its cells, by the rules of ``best_splits``."""
    left = np.cumsum(sums, axis=3)
    total = totals.T[:, None, :, None]
    right = total - left
    good = np.minimum(left[2], right[2]) >= max(params.min_rows, 1) - 0.5
    good &= np.minimum(left[1], right[1]) >= params.min_weight
    f, leaf, cut = np.nonzero(good)
    (a, b), (c, d), (g, h) = (x[:2, f, leaf, cut] for x in (left, right, np.broadcast_to(total, left.shape)))
    gain = score(a, b, params) + score(c, d, params) - score(g, h, params)
    kept = np.flatnonzero(gain > max(params.min_gain, 1e-12))
    f, leaf, cut, gain = f[kept], leaf[kept], cut[kept], gain[kept]
    unit = 2.0 ** (np.ceil(np.log2(gain)) - 32)
    gain = np.round(gain / unit) * unit
    order = np.lexsort((cut, f, -gain, leaf))
    top = order[np.flatnonzero(np.r_[True, leaf[order][1:] != leaf[order][:-1]])] if len(order) else order
    return [
        {"leaf": int(first + leaf[i]), "feature": int(f[i]), "cut": int(cut[i]), "gain": float(gain[i])}
        | {name: float(left[j, f[i], leaf[i], cut[i]]) for j, name in enumerate(("g", "h", "n"))}
        for i in top
    ]


def boosted(rows: InSpark | InTask | InColumns | InCells | SharedCells, bins: Bins, params: Params) -> Iterator[tuple[list[Tree], float | None, float | None]]:
    """Round by round: the trees it has added (none at the start), and the losses after them."""
    best, best_loss, last = 0, None, []
    for number in range(params.rounds + 1):
        totals, train, held = rows.advance(last, number)
        yield last, train, held
        if held is not None and (best_loss is None or held < best_loss - 1e-12):
            best, best_loss = number, held
        if number == params.rounds or not totals or (held is not None and number - best >= params.patience):
            return
        last = grown(rows.search, totals, bins, params, number)
        if all(len(t.feature) == 1 for t in last) and params.rows == 1 and params.columns == 1:
            return  # nothing gains any more


def binned_rows(rows: DataFrame, bins: Bins, query: bool, parts: int) -> DataFrame:
    """Stored rows as cells, in ``parts`` partitions (rows of a query together unless it is hot)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = batch.column("pairs")
            flat, offsets = pairs.flatten(), pairs.offsets.to_numpy()
            index, values = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(2))
            cells = bins.entries(index, values)
            # what falls into the bin of zero is left out
            keep = cells - bins.first[index] != bins.zero[index]
            upto = np.concatenate([[0], np.cumsum(keep)])
            entries = pa.ListArray.from_arrays(pa.array(upto[offsets - offsets[0]], pa.int32()), pa.array(cells[keep].astype(np.int32)))
            names = ["uid", "query", "y", "w", "held"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], entries], [*names, "entries"])

    found = rows.mapInArrow(cut, ROW)
    if query:
        salt = F.when(F.col("w") < 0, F.pmod(F.xxhash64("uid"), F.lit(parts))).otherwise(0)
        found = found.repartition(parts, "query", salt).sortWithinPartitions("query", "uid")
    else:
        found = found.repartition(parts, "uid").sortWithinPartitions("uid")
    return stage(found, "binned")


@dataclass
class Binned:
    """Rows that are ready to be boosted, as often as wanted."""

    table: DataFrame
    bins: Bins
    parts: int
    hot: list
    cells: int = 0  # values, or cells of many features


def binned(
    rows: DataFrame,
    label: str,
    objective: Objective,
    bins: int = 64,
    weight: str | None = None,
    held: str | None = None,
    group: str | None = None,
    part_cells: int | None = None,
) -> Binned:
    """``rows`` (with a vector ``features``) in bins.  ``group`` is the query of a ranking, or a fold.

    ``part_cells`` deals them to partitions of that size, however few features they have.
    """
    chosen = stage(
        rows.select(
            F.monotonically_increasing_id().alias("uid"),
            (F.col(group).cast("long") if group else F.lit(0).cast("long")).alias("query"),
            F.col(label).cast("double").alias("y"),
            (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"),
            (F.coalesce(F.col(held), F.lit(False)) if held else F.lit(False)).alias("held"),
            F.size(vector_to_array("features")).alias("width"),
            nonzero().alias("pairs"),
        ),
        "to-boost",
    )
    n_rows, width, cells = chosen.agg(F.count(F.lit(1)), F.max("width"), F.sum(F.size("pairs"))).first()
    if not n_rows:
        raise ValueError("no rows to train on")
    found = fit_bins(chosen, width, bins)
    size = n_rows * width if width <= DENSE_FEATURES else cells
    side_by_side = group is not None and not objective.by_query
    if part_cells is None and size <= (TASK_CELLS * 2 // 3 if width > DENSE_FEATURES or side_by_side else TASK_CELLS):
        parts = 1
    else:
        parts = max(1, min(-(-(cells + n_rows) // (part_cells or PART_CELLS)), 16 * shuffle_width(rows)))
    chosen, hot = objective.marked_hot(chosen, n_rows) if parts > 1 else (chosen, [])
    return Binned(binned_rows(chosen, found, objective.by_query, parts), found, parts, hot, size)


def cores(spark: SparkSession) -> int:
    """What an executor has for one task that runs alone."""
    context = spark.sparkContext
    if re.match(r"local(\[|$)", context.master):
        return context.defaultParallelism
    cluster = re.match(r"local-cluster\[\s*\d+\s*,\s*(\d+)", context.master)
    return int(cluster[1] if cluster else context.getConf().get("spark.executor.cores", "1"))


def train(ready: Binned, objective: Objective, params: Params = Params(), names: Sequence[str] = (), without: int | None = None) -> Booster:
    """Boost the rows of ``ready``, but for the group ``without``.

    Rows with ``held`` true are not trained on; training stops after ``patience`` rounds without a
    better loss on them, and the rounds up to the best one are kept; the model's ``history`` has both
    losses after every round.  A query with very many rows is spread over the partitions.
    """
    bins = ready.bins
    table = ready.table if without is None else ready.table.where(F.col("query") != without)
    base = objective.start(table.where("NOT held"))
    if ready.parts > 1:
        place = InSpark(table, bins, base, objective, params, ready.hot, ready.parts)
        steps = list(boosted(place, bins, params))
        place.close()
    else:
        few = len(bins.cuts) <= DENSE_FEATURES
        # the models of a search are trained side by side, and a query is not taken apart
        helpers = 1 if without is not None or objective.by_query else min(cores(table.sparkSession), MOST_HELPERS, ready.cells // HELPER_CELLS[not few])

        def rounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = (b for b in batches if b.num_rows)
            first = next(found, None)
            if first is None:
                return
            hands = min(helpers, len(os.sched_getaffinity(0)) if hasattr(os, "sched_getaffinity") else 1)
            given = (chain([first], found), bins, base, objective, params)
            if hands > 1:
                place = (SharedColumns if few else SharedCells)(*given, hands)
            else:
                place = (InColumns if few else InCells)(*given)
            try:
                for number, (trees, *losses) in enumerate(boosted(place, bins, params)):
                    body = json.dumps([asdict(t) for t in trees])
                    yield pa.RecordBatch.from_pylist([{"number": number, "body": body, "train": losses[0], "held": losses[1]}], TRAINED)
            finally:
                if hands > 1:
                    place.close()

        # one file, so one partition, and its rows keep their order
        done = table.coalesce(1).mapInArrow(rounds, "number int, body string, train double, held double").collect()
        steps = [([Tree(**t) for t in json.loads(r["body"])], r["train"], r["held"]) for r in sorted(done, key=lambda r: r["number"])]
    history = [(number, *losses) for number, (_, *losses) in enumerate(steps)]
    judged = [(held, number) for number, _, held in history if held is not None]
    most = min(judged)[1] if judged else len(steps) - 1
    return Booster(bins.cuts, [trees for trees, *_ in steps[1 : most + 1]], list(base), objective, list(names), history)


def fit(
    rows: DataFrame,
    label: str,
    objective: Objective,
    params: Params = Params(),
    weight: str | None = None,
    held: str | None = None,
    query: str | None = None,
    names: Sequence[str] = (),
    part_cells: int | None = None,
) -> Booster:
    """Bin ``rows`` (with a vector ``features``) and boost them; see ``train``."""
    return train(binned(rows, label, objective, params.bins, weight, held, query, part_cells), objective, params, names)


def margins_of(rows: Rows, rounds: Sequence[Sequence[Tree]], base: Sequence[float]) -> np.ndarray:
    """Margins of rows in bins after all rounds."""
    out = np.tile(np.array(base, float), (len(rows.sizes), 1))
    for trees in rounds:
        for k, (tree, node) in enumerate(zip(trees, rows.nodes(trees))):
            out[:, k] += np.array(tree.value)[node]
    return out


# ------------------------------------------------------------------ the model


class Booster(Model, MLReadable, MLWritable):
    """Fitted trees.  Adds ``prediction``, and ``probability`` where the objective has classes."""

    def __init__(self, cuts=(), rounds=(), base=(), objective: Objective | None = None, names=(), history=()):
        super().__init__()
        self.cuts, self.rounds, self.base = [list(c) for c in cuts], [list(r) for r in rounds], list(base)
        self.objective, self.names, self.history = objective, list(names), [tuple(x) for x in history]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        bins, rounds, base, objective = Bins(self.cuts), self.rounds, self.base, self.objective

        @F.pandas_udf("array<double>")
        def margins(pairs):
            column = pa.array(pairs, pa.list_(pa.struct([("i", pa.int32()), ("x", pa.float64())])))
            flat = column.flatten()
            index, values = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(2))
            cells = pa.ListArray.from_arrays(column.offsets, pa.array(bins.entries(index, values), pa.int32()))
            return pairs.__class__(list(objective.answers(margins_of(Rows(cells, bins), rounds, base))))

        found = dataset.withColumn("_answers", margins(nonzero()))
        if not objective.classes:
            return found.withColumn("prediction", F.col("_answers")[0]).drop("_answers")
        top = F.array_max("_answers")
        return found.withColumns({
            "prediction": (F.array_position("_answers", top) - 1).cast("double"), "probability": array_to_vector("_answers"),
        }).drop("_answers")

    @property
    def featureImportances(self) -> DenseVector:
        """Share of every feature in the gains of all splits."""
        total = np.zeros(len(self.cuts))
        for trees in self.rounds:
            for t in trees:
                for f, gain in zip(t.feature, t.gain):
                    if f >= 0:
                        total[f] += gain
        return DenseVector(total / total.sum() if total.sum() else total)

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: Booster):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        model = self.model
        DefaultParamsWriter.saveMetadata(model, path, self.sparkSession)
        head = {"cuts": model.cuts, "base": model.base, "objective": model.objective.described(), "names": model.names, "history": model.history}
        lines = [(0, json.dumps(head))] + [(k + 1, json.dumps([asdict(t) for t in trees])) for k, trees in enumerate(model.rounds)]
        self.sparkSession.createDataFrame(lines, "round int, body string").coalesce(1).write.parquet(f"{path}/data")


class _Reader(MLReader):
    def load(self, path: str) -> Booster:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        lines = [json.loads(r["body"]) for r in self.sparkSession.read.parquet(f"{path}/data").orderBy("round").collect()]
        head, rounds = lines[0], [[Tree(**t) for t in trees] for trees in lines[1:]]
        model = Booster(head["cuts"], rounds, head["base"], objective_of(head["objective"]), head["names"], head["history"])
        model._resetUid(metadata["uid"])
        return model

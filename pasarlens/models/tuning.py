"""Adaptive search over parameter ranges with cross-validation, and feature importance.

The search is a tree-structured Parzen estimator.  After some random trials the finished ones are
split into the best fifth and the rest; per parameter a density is laid over both, and of a few
values drawn from the good one that with the largest ratio of densities is tried next.  Trials are
chosen in rounds of fixed size, each from the trials of earlier rounds alone, so a search takes the
same trials however its parts run.  The fits of a round run side by side, one pass scores them all,
and the round is written to the trial log: a search that is started again goes on after the last
round in it.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pasarlens.models.boosting import Binned, Booster, Params, Rows, margins_of, train
from pasarlens.models.objectives import Objective
from pasarlens.operators.topk import top_n
from pasarlens.plans.jobs import at_once, path_exists

# Trials before the first density, trials of a round, values that are drawn per parameter.
STARTUP, ROUND, CANDIDATES = 10, 5, 24
GOOD_SHARE = 0.2
# Areas under the ROC are taken from scores in so many steps: that bounds what a window sorts.
SCORE_STEPS = 1 << 16
LOG_SCHEMA = "trial int, params string, score double"


@dataclass(frozen=True)
class Range:
    """Values of a parameter: whole numbers, numbers, or numbers on a log scale."""

    low: float
    high: float
    kind: str = "float"

    def value(self, share: float) -> float | int:
        """The value at a share (0 to 1) of the range."""
        if self.kind == "int":
            return min(int(self.low) + int(share * (self.high - self.low + 1)), int(self.high))
        if self.kind == "log":
            return math.exp(math.log(self.low) + share * (math.log(self.high) - math.log(self.low)))
        return self.low + share * (self.high - self.low)

    def share(self, value: float) -> float:
        if self.kind == "int":
            return (value - self.low + 0.5) / (self.high - self.low + 1)
        if self.kind == "log":
            return (math.log(value) - math.log(self.low)) / (math.log(self.high) - math.log(self.low))
        return (value - self.low) / (self.high - self.low) if self.high > self.low else 0.5


# Search ranges of the two tuned tasks, by the parameters of boosting.
CHURN_SPACE = {
    "rounds": Range(200, 800, "int"),
    "depth": Range(3, 10, "int"),
    "step": Range(0.01, 0.3, "log"),
    "rows": Range(0.6, 1.0),
    "columns": Range(0.6, 1.0),
    "min_weight": Range(1, 10, "int"),
    "min_gain": Range(0.0, 1.0),
    "l1": Range(1e-5, 10, "log"),
    "l2": Range(1e-5, 10, "log"),
}
LTV_SPACE = {
    "rounds": Range(200, 1000, "int"),
    "depth": Range(3, 10, "int"),
    "step": Range(0.005, 0.2, "log"),
    "leaves": Range(20, 200, "int"),
    "min_rows": Range(10, 100, "int"),
    "rows": Range(0.6, 1.0),
    "columns": Range(0.6, 1.0),
    "l1": Range(1e-5, 10, "log"),
    "l2": Range(1e-5, 10, "log"),
}


# ------------------------------------------------------------------ choosing trials


class Density:
    """Bell curves around the tried shares of a range, as wide as the gaps beside them, and the whole
    range as one more of them."""

    def __init__(self, points: Sequence[float]):
        self.points = np.sort(np.array(points, float))
        gaps = np.diff(np.r_[0.0, self.points, 1.0])
        least = 1 / (2 + 2 * len(self.points))
        self.widths = np.clip(np.minimum(gaps[:-1], gaps[1:]) if len(self.points) else gaps[:0], least, 0.25)

    def draw(self, chance: np.random.Generator, n: int) -> np.ndarray:
        which = chance.integers(0, len(self.points) + 1, n)
        flat = which == len(self.points)
        near = np.append(self.points, 0.5)[which] + np.append(self.widths, 0.0)[which] * chance.normal(size=n)
        near = np.abs(near) % 2  # folded back into the range
        return np.where(flat, chance.uniform(size=n), np.where(near > 1, 2 - near, near))

    def at(self, x: np.ndarray) -> np.ndarray:
        total = np.ones(len(x))
        for image in (x, -x, 2 - x):
            z = (image[:, None] - self.points[None, :]) / self.widths
            total += (np.exp(-z * z / 2) / (self.widths * math.sqrt(2 * math.pi))).sum(axis=1)
        return total / (len(self.points) + 1)


@dataclass(frozen=True)
class Trial:
    number: int
    params: dict
    score: float  # larger is better


def suggested(space: Mapping[str, Range], done: Sequence[Trial], number: int, seed: int, startup: int = STARTUP) -> dict:
    """Parameters of trial ``number``, from the finished trials."""
    chance = np.random.default_rng([seed, number])
    if len(done) < startup:
        return {name: values.value(chance.uniform()) for name, values in space.items()}
    ranked = sorted(done, key=lambda t: (-t.score, t.number))
    cut = max(1, math.ceil(GOOD_SHARE * len(ranked)))
    chosen = {}
    for name, values in space.items():
        good, rest = (Density([values.share(t.params[name]) for t in part]) for part in (ranked[:cut], ranked[cut:]))
        drawn = np.clip(good.draw(chance, CANDIDATES), 0.0, 1.0)
        chosen[name] = values.value(float(drawn[np.argmax(good.at(drawn) / rest.at(drawn))]))
    return chosen


def searched(
    score: Callable[[list[dict]], list[float]],
    space: Mapping[str, Range],
    trials: int = 30,
    seed: int = 42,
    startup: int = STARTUP,
    log: TrialLog | None = None,
) -> list[Trial]:
    """All trials in order; ``score`` judges the parameters of one round."""
    done: list[Trial] = log.trials() if log else []
    while len(done) < trials:
        size = min(startup - len(done) if len(done) < startup else ROUND, trials - len(done))
        chosen = [suggested(space, done, len(done) + i, seed, startup) for i in range(size)]
        found = [Trial(len(done) + i, p, float(s)) for i, (p, s) in enumerate(zip(chosen, score(chosen)))]
        if log:
            log.add(found)
        done = done + found
    return done[:trials]


class TrialLog:
    """Finished trials as a table, one part per round."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def table(self) -> DataFrame:
        return self.spark.read.schema(LOG_SCHEMA).json(f"{self.path}/*")

    def trials(self) -> list[Trial]:
        if not path_exists(self.spark, self.path):
            return []
        rows = sorted(self.table().collect(), key=lambda r: r["trial"])
        whole = [r for i, r in enumerate(rows) if r["trial"] == i]
        return [Trial(r["trial"], json.loads(r["params"]), r["score"]) for r in whole]

    def add(self, found: Sequence[Trial]) -> None:
        lines = [(t.number, json.dumps(t.params), t.score) for t in found]
        self.spark.createDataFrame(lines, LOG_SCHEMA).coalesce(1).write.mode("overwrite").json(f"{self.path}/from={found[0].number}")


# ------------------------------------------------------------------ judging boosted models


def fold_scores(ready: Binned, fitted: Sequence[tuple[int, Booster]], metric: str) -> list[float]:
    """``auc`` or ``rmse`` (negative) of every (fold, model) on the rows of that fold, in one pass."""
    bins = ready.bins

    def judged(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], np.ndarray] = {}
        for batch in parts:
            if not batch.num_rows:
                continue
            fold, y = (batch.column(c).to_numpy() for c in ("query", "y"))
            of_fold = {out: Rows(batch.column("entries").filter(pa.array(fold == out)), bins) for out in {out for out, _ in fitted}}
            for i, (out, model) in enumerate(fitted):
                mine = fold == out
                if not mine.any():
                    continue
                margin = margins_of(of_fold[out], model.rounds, model.base)[:, 0]
                if metric == "rmse":
                    steps, sums = np.zeros(1, int), [[((margin - y[mine]) ** 2).sum()], [float(mine.sum())]]
                else:
                    step = np.floor((SCORE_STEPS - 1) / (1 + np.exp(-np.clip(margin, -500, 500)))).astype(int)
                    steps, place = np.unique(step, return_inverse=True)
                    sums = [np.bincount(place, v, minlength=len(steps)) for v in (y[mine], 1 - y[mine])]
                for step, a, b in zip(steps, *sums):
                    key = i, int(step)
                    found[key] = found.get(key, 0) + np.array([a, b])
        columns = list(zip(*[(*k, float(v[0]), float(v[1])) for k, v in found.items()])) or [[]] * 4
        kinds = (pa.int32(), pa.int32(), pa.float64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["model", "step", "a", "b"])

    # a table of one partition is trained on by one task; its rows are judged by all
    table = ready.table if ready.parts > 1 else ready.table.repartition(ready.table.sparkSession.sparkContext.defaultParallelism, "uid")
    sums = table.mapInArrow(judged, "model int, step int, a double, b double").groupBy("model", "step").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    if metric == "rmse":
        value = -F.sqrt(F.sum("a") / F.sum("b"))
        rows = sums.groupBy("model").agg(value.alias("v")).collect()
    else:
        upto = Window.partitionBy("model").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)  # SCORE_STEPS rows at most
        below = sums.withColumn("wins", F.col("a") * (F.sum("b").over(upto) - F.col("b") / 2))
        rows = below.groupBy("model").agg((F.sum("wins") / F.nullif(F.sum("a") * F.sum("b"), F.lit(0.0))).alias("v")).collect()
    by_model = {r["model"]: r["v"] for r in rows}
    return [by_model[i] if by_model.get(i) is not None else (0.5 if metric == "auc" else -math.inf) for i in range(len(fitted))]


def expected_work(params: Params) -> float:
    """What a training will take, in no unit: the smaller its steps, the later it stops."""
    return min(params.rounds, 10 / params.step) * params.depth * params.rows * params.columns


def cross_validated(ready: Binned, objective: Objective, base: Params, metric: str, folds: int) -> Callable[[list[dict]], list[float]]:
    """Judge a round of parameters: mean metric over the folds (``query`` of the rows)."""

    def score(round_: list[dict]) -> list[float]:
        spark = ready.table.sparkSession
        wanted = [(Params(**{**base.__dict__, **p}), fold) for p in round_ for fold in range(folds)]
        # the longest are started first: no core waits for one that was started late
        order = sorted(range(len(wanted)), key=lambda i: -expected_work(wanted[i][0]))
        jobs = {str(i): lambda p=wanted[i][0], fold=wanted[i][1]: train(ready, objective, p, without=fold) for i in order}
        models = at_once(spark, jobs)
        values = fold_scores(ready, [(fold, models[str(i)]) for i, (_, fold) in enumerate(wanted)], metric)
        return [float(np.mean(values[i * folds : (i + 1) * folds])) for i in range(len(round_))]

    return score


@dataclass
class Found:
    """A finished search: its trials and the model of the best one, fitted on all rows."""

    model: Booster
    trials: list[Trial]

    @property
    def best(self) -> Trial:
        return max(self.trials, key=lambda t: (t.score, -t.number))


def adaptive_search(
    ready: Binned,
    objective: Objective,
    space: Mapping[str, Range],
    metric: str,
    base: Params = Params(),
    trials: int = 30,
    folds: int = 3,
    seed: int = 42,
    names: Sequence[str] = (),
    log: TrialLog | None = None,
) -> Found:
    """Cross-validate ``trials`` parameter choices; the best one is fitted on all rows."""
    done = searched(cross_validated(ready, objective, base, metric, folds), space, trials, seed, log=log)
    best = max(done, key=lambda t: (t.score, -t.number))
    return Found(train(ready, objective, Params(**{**base.__dict__, **best.params}), names), done)


def importance(spark: SparkSession, model: Model, names: Sequence[str], n: int = 20) -> DataFrame:
    """The ``n`` most important features of a fitted tree model."""
    values = [(name, float(v)) for name, v in zip(names, model.featureImportances.toArray())]
    table = spark.createDataFrame(values, "feature string, importance double")
    return top_n(table, [F.desc("importance"), F.asc("feature")], n)

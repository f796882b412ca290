"""The adaptive search, its log, and jobs that run side by side."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pasarlens.models import boosting as B
from pasarlens.models import objectives as O
from pasarlens.models import tuning as T
from pasarlens.operators.joins import unseen_of_users
from pasarlens.plans import jobs as J
from tests.test_boosting import frame

SPACE = {"a": T.Range(0.001, 10, "log"), "b": T.Range(1, 9, "int"), "c": T.Range(-1.0, 1.0)}


def surface(params):
    """Highest where a is 0.1, b is 7 and c is 0.4."""
    return -(math.log10(params["a"] / 0.1) ** 2 + (params["b"] - 7) ** 2 / 10 + 4 * (params["c"] - 0.4) ** 2)


def test_suggestions_lie_in_range_and_repeat():
    done = []
    for number in range(40):
        chosen = T.suggested(SPACE, done, number, 3)
        assert chosen == T.suggested(SPACE, list(done), number, 3)
        assert all(SPACE[k].low <= v <= SPACE[k].high for k, v in chosen.items()) and isinstance(chosen["b"], int)
        done.append(T.Trial(number, chosen, surface(chosen)))
    for values in SPACE.values():
        assert [values.share(values.value(s)) for s in (0.1, 0.5, 0.9)] == pytest.approx([0.1, 0.5, 0.9], abs=0.06)
        assert values.value(0.0) == pytest.approx(values.low) and values.value(1.0) == pytest.approx(values.high)


def test_search_beats_chance():
    def best(seed, startup):
        return max(t.score for t in T.searched(lambda r: [surface(p) for p in r], SPACE, 30, seed, startup))

    adaptive, random = (np.median([best(s, k) for s in range(40)]) for k in (10, 30))
    assert adaptive > random + 0.05


def test_density_is_one_over_the_range():
    x = np.linspace(0, 1, 2001)
    for points in ([], [0.02], [0.2, 0.25, 0.9]):
        density = T.Density(points)
        assert np.trapezoid(density.at(x), x) == pytest.approx(1, abs=0.02)
        drawn = density.draw(np.random.default_rng(0), 500)
        assert drawn.min() >= 0 and drawn.max() <= 1


def test_a_stopped_search_goes_on(spark, tmp_path):
    asked = []

    def score(round_):
        asked.extend(round_)
        if len(asked) == 20:
            raise KeyboardInterrupt
        return [surface(p) for p in round_]

    whole = T.searched(lambda r: [surface(p) for p in r], SPACE, 25, 1)
    log = T.TrialLog(spark, f"{tmp_path}/log")
    with pytest.raises(KeyboardInterrupt):
        T.searched(score, SPACE, 25, 1, log=log)
    assert len(log.trials()) == 15
    assert T.searched(score, SPACE, 25, 1, log=log) == whole and len(asked) == 30
    assert T.searched(score, SPACE, 25, 1, log=log) == whole and len(asked) == 30
    assert log.table().count() == 25


@pytest.mark.parametrize("metric", ["auc", "rmse"])
def test_fold_scores(spark, metric):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 3))
    y = (x[:, 0] + rng.normal(size=300) > 0).astype(int) if metric == "auc" else x[:, 0] + x[:, 1]
    rows = frame(spark, x, y, fold=(np.arange(300) % 3).tolist(), held=(np.arange(300) % 7 == 0).tolist())
    objective = O.Logistic() if metric == "auc" else O.Squared()
    ready = B.binned(rows, "y", objective, held="held", group="fold", part_cells=200)
    models = [(k, B.train(B.Binned(ready.table, ready.bins, 1, []), objective, B.Params(rounds=5, step=0.3), without=k)) for k in (0, 2)]
    got = T.fold_scores(ready, models, metric)
    for (fold, model), value in zip(models, got):
        found = model.transform(rows.where(F.col("fold") == fold)).select("y", "prediction", *(["probability"] if metric == "auc" else [])).toPandas()
        if metric == "rmse":
            assert value == pytest.approx(-math.sqrt(((found["y"] - found["prediction"]) ** 2).mean()))
        else:
            p = np.array([v[1] for v in found["probability"]])
            one, zero = p[found["y"] == 1], p[found["y"] == 0]
            want = ((one[:, None] > zero).sum() + 0.5 * (one[:, None] == zero).sum()) / (len(one) * len(zero))
            assert value == pytest.approx(want, abs=2e-3)


def test_adaptive_search_fits_the_best_on_all_rows(spark, tmp_path):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 3))
    rows = frame(spark, x, (x[:, 0] > 0).astype(int), fold=(np.arange(200) % 2).tolist(), held=[False] * 200)
    ready = B.binned(rows, "y", O.Logistic(), held="held", group="fold")
    space = {"rounds": T.Range(1, 6, "int"), "l2": T.Range(0.01, 5, "log")}
    found = T.adaptive_search(ready, O.Logistic(), space, "auc", B.Params(depth=2), trials=6, folds=2, log=T.TrialLog(spark, f"{tmp_path}/t"))
    assert len(found.trials) == 6 and found.best.score == max(t.score for t in found.trials) > 0.9
    assert len(found.model.rounds) == found.best.params["rounds"]


def test_jobs_run_side_by_side(spark):
    def count(n):
        return lambda: spark.range(n).count()

    assert J.at_once(spark, {str(n): count(n) for n in range(20)}) == {str(n): n for n in range(20)}
    seen = []

    def broken():
        raise ValueError("broken")

    with pytest.raises(ValueError):
        J.at_once(spark, {"a": broken, "b": lambda: seen.append(spark.range(3).count())})
    assert seen == [3] and J.at_once(spark, {}) == {}


def test_results_are_made_once(spark, tmp_path):
    made = []

    def make():
        made.append(1)
        return 7

    def save(value, path):
        spark.createDataFrame([(value,)], "v int").write.mode("overwrite").parquet(f"{path}/v")

    def load(path):
        return spark.read.parquet(f"{path}/v").first()["v"]

    path = f"{tmp_path}/kept"
    save(3, path)  # half written: the mark is missing
    assert [J.finished(spark, path, make, save, load) for _ in range(3)] == [7, 7, 7] and made == [1]
    both = J.at_once(spark, {k: lambda: J.finished(spark, f"{tmp_path}/both", make, save, load) for k in "ab"})
    assert both == {"a": 7, "b": 7} and made == [1, 1]


def test_keys_follow_the_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "i int, s string")
    assert J.content_key(df) == J.content_key(df.repartition(3))
    others = [df.distinct(), df.limit(0), df.withColumnRenamed("s", "t"), df.withColumn("s", F.lit("a"))]
    keys = {J.content_key(x) for x in [df, *others]}
    assert len(keys) == 5
    assert J.work_path(spark, "x", [df], 1) != J.work_path(spark, "x", [df], 2)


@pytest.mark.parametrize("block", [3, 32_768])
def test_unseen_items_of_many_users(spark, block):
    rng = np.random.default_rng(2)
    pairs = [(int(u), int(p)) for u, p in rng.integers(0, 20, (150, 2))] + [(3, p) for p in range(20)] + [(None, 1), (4, None)]
    df = spark.createDataFrame(pairs, "user_id long, product_id long")
    asked = [3, 4, 5, 99, 5, None]
    got = [tuple(r) for r in unseen_of_users(df, spark.createDataFrame([(u,) for u in asked], "user_id long"), block).collect()]
    items = {p for u, p in pairs if u is not None and p is not None}
    want = {(u, p) for u in {3, 4, 5, 99} for p in items if (u, p) not in pairs}
    assert sorted(got) == sorted(want)
    assert unseen_of_users(df.limit(0), df, block).count() == 0
    with pytest.raises(ValueError):
        unseen_of_users(df, df, 0)


def test_long_trainings_start_first(spark, monkeypatch):
    started = []

    def told(session, jobs):
        started.extend(jobs)
        return {name: name for name in jobs}

    monkeypatch.setattr(T, "at_once", told)
    monkeypatch.setattr(T, "fold_scores", lambda ready, fitted, metric: [10.0 * int(model) + fold for fold, model in fitted])
    ready = B.Binned(spark.range(1), B.Bins([[0.0]]), 1, [])
    score = T.cross_validated(ready, O.Logistic(), B.Params(rounds=400), "auc", 2)
    values = score([{"depth": 3}, {"depth": 9}, {"depth": 6}, {"depth": 9, "step": 0.5}])
    assert started == ["2", "3", "4", "5", "0", "1", "6", "7"]
    assert values == [(10 * 2 * i + 10 * (2 * i + 1) + 1) / 2 for i in range(4)]  # the scores stay with their parameters

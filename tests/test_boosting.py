"""Boosting against brute force: gradients, pairs, splits, and what the models reach."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from pasarlens.models import boosting as B
from pasarlens.models import objectives as O


def frame(spark, x, y, **more):
    names = list(more)
    rows = [(i, Vectors.dense(v) if i % 2 else Vectors.sparse(len(v), {k: float(a) for k, a in enumerate(v) if a}), float(t), *[c[i] for c in more.values()]) for i, (v, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, ["id", "features", "y", *names])


def row(y, w=None, **more):
    return {"y": np.array(y, float), "w": np.ones(len(y)) if w is None else np.array(w, float), **more}


@pytest.mark.parametrize("objective", [O.Squared(), O.Logistic(), O.Softmax(4)], ids=lambda o: type(o).__name__)
def test_gradients_are_those_of_the_loss(objective):
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2 if objective.classes == 2 else 4, 50)
    rows, margins = row(y, rng.uniform(0.5, 2, 50)), rng.normal(size=(50, objective.width))
    g, h, loss, weight = objective.gradients(margins, rows, None)
    scale = 2 if isinstance(objective, O.Squared) else 1  # half the squared error is what is followed
    for k in range(objective.width):
        step = np.zeros_like(margins)
        step[:, k] = 1e-5
        up, down = (objective.gradients(margins + s * step, rows, None) for s in (1, -1))
        assert np.allclose((up[2] - down[2]) / 2e-5, scale * g[:, k], atol=1e-6)
        curve = (up[0][:, k] - down[0][:, k]) / 2e-5
        assert np.allclose(curve * (2 if isinstance(objective, O.Softmax) else 1), h[:, k], atol=1e-6)
    assert (weight == rows["w"]).all()


def lambdas_by_force(s, y, uid, gains, truncation):
    """All pairs: what exchanging two rows does to NDCG at the truncation."""
    order = sorted(range(len(s)), key=lambda i: (-s[i], uid[i]))
    place = {i: p for p, i in enumerate(order)}

    def discount(p):
        return 1 / np.log2(p + 2) if p < truncation else 0.0

    best = sum(g * discount(p) for p, g in enumerate(sorted((gains[int(t)] for t in y), reverse=True)))
    g, h = np.zeros(len(s)), np.zeros(len(s))
    for i in range(len(s)):
        for j in range(len(s)):
            if best and y[i] > y[j]:
                moved = abs((gains[int(y[i])] - gains[int(y[j])]) * (discount(place[i]) - discount(place[j]))) / best
                p = 1 / (1 + np.exp(s[i] - s[j]))
                g[i] -= p * moved
                g[j] += p * moved
                h[i] += p * (1 - p) * moved
                h[j] += p * (1 - p) * moved
    ndcg = sum(gains[int(y[i])] * discount(place[i]) for i in range(len(s))) / best if best else 1.0
    return g, h, ndcg


@pytest.mark.parametrize("n, truncation", [(1, 5), (2, 1), (7, 30), (40, 5), (60, 30)])
def test_lambdas_equal_all_pairs(n, truncation):
    rng = np.random.default_rng(n)
    objective = O.LambdaRank(truncation=truncation)
    for levels in (1, 2, 4):
        s, y, uid = np.round(rng.normal(size=n), 1), rng.integers(0, levels, n).astype(float), rng.permutation(n)
        got, want = objective.of_query(s, y, uid), lambdas_by_force(s, y, uid, objective.gains, truncation)
        # the sign: the loss falls where the margin of the better row grows
        assert np.allclose(-got[0], -want[0]) and np.allclose(got[1], want[1]) and np.isclose(got[2], want[2])


def batch_of(query, uid, y, s):
    return pa.RecordBatch.from_pydict({
        "uid": np.array(uid), "query": np.array(query), "y": np.array(y, float), "w": np.ones(len(y)),
        "held": np.zeros(len(y), bool), "entries": pa.array([[]] * len(y), pa.list_(pa.int32())),
        "margins": pa.array([[float(v)] for v in s], pa.list_(pa.float64())),
    })


def test_queries_may_cross_batches():
    objective = O.LambdaRank()
    whole = batch_of([1, 1, 2, 2, 2, 2, 5], range(7), [0] * 7, range(7))
    for cuts in ([0, 7], [0, 1, 7], [0, 3, 4, 5, 7], [0, 2, 6, 7], list(range(8))):
        found = list(objective.batches(iter([whole.slice(a, z - a) for a, z in zip(cuts, cuts[1:])])))
        assert [r for b in found for r in b.column("uid").to_pylist()] == list(range(7))
        ends = [set(b.column("query").to_pylist()) for b in found]
        assert all(not a & b for i, a in enumerate(ends) for b in ends[i + 1 :])


def test_a_hot_query_in_parts_has_the_same_lambdas(spark):
    rng = np.random.default_rng(3)
    n = 500
    query, y, s = np.where(np.arange(n) < 350, 7, 9), rng.integers(0, 4, n), np.round(rng.normal(size=n), 2)
    table = [(int(q), i, float(t), [float(v)]) for i, (q, t, v) in enumerate(zip(query, y, s))]
    rows = spark.createDataFrame(table, "query long, uid long, y double, margins array<double>").repartition(6)
    objective = O.LambdaRank(truncation=10, hot_rows=200)
    marked, hot = objective.marked_hot(rows, n)
    assert hot == [7] and marked.where("w < 0").count() == 350
    context = objective.context(rows, hot)
    want = objective.of_query(s[:350], y[:350].astype(float), np.arange(350))
    g, told = np.zeros(350), []
    h = np.zeros(350)
    for part in np.array_split(rng.permutation(350), 5):
        g[part], h[part], ndcg, leader = objective.of_part(context[7], s[part], y[part].astype(float), part)
        told += [] if leader is None else [ndcg]
    assert np.allclose(g, want[0]) and np.allclose(h, want[1]) and np.allclose(told, [want[2]])


def splits_by_force(x, g, h, params, allowed=None):
    """The best split of all rows: gain and left side."""
    found = []

    def t(v):
        return np.sign(v) * max(abs(v) - params.l1, 0)

    for f in range(x.shape[1]) if allowed is None else allowed:
        for v in np.unique(x[:, f])[:-1]:
            left = x[:, f] <= v
            if min(left.sum(), (~left).sum()) < params.min_rows or min(h[left].sum(), h[~left].sum()) < params.min_weight:
                continue
            gain = sum(t(g[m].sum()) ** 2 / (h[m].sum() + params.l2) for m in (left, ~left)) - t(g.sum()) ** 2 / (h.sum() + params.l2)
            found.append((gain, f, tuple(np.flatnonzero(left))))
    return max(found, default=None)


@pytest.mark.parametrize("parts", [1, 3])
@pytest.mark.parametrize(
    "params",
    [B.Params(l2=0.0), B.Params(l1=0.8, l2=2.0), B.Params(min_rows=12), B.Params(min_weight=4.0), B.Params(min_gain=1e9), B.Params(columns=0.4)],
    ids=["plain", "l1 l2", "rows", "weight", "gain", "columns"],
)
def test_splits_equal_a_search_over_all(spark, params, parts):
    rng = np.random.default_rng(1)
    n = 60
    x = np.stack([rng.integers(-2, 4, n), rng.normal(size=n).round(1), rng.integers(0, 2, n) * rng.uniform(1, 2, n).round(1), np.zeros(n), -rng.integers(0, 3, n)], axis=1)
    g, h = rng.normal(size=n), rng.uniform(0.1, 1, n)
    # as many cut points as values, so that bins lose nothing
    bins = B.Bins([list(np.unique(c)[:-1]) for c in x.T])
    cells = []
    for v in x:
        c = bins.entries(np.arange(5), v)
        keep = c - bins.first != bins.zero
        cells.append([int(e) for e in c[keep]])
    rows = [(i, 0, 0.0, 1.0, False, cells[i], [0.0], [float(g[i])], [float(h[i])], True, 0.0, 0.0) for i in range(n)]
    state = spark.createDataFrame(rows, B.STATE).repartition(parts)
    one = B.Params(**{**params.__dict__, "depth": 1})
    place = B.InSpark(state, bins, [0.0], O.Squared(), one, [], parts)
    (tree,) = B.grown(place.search, [(g.sum(), h.sum(), float(n))], bins, one, 0)
    place = B.InTask(iter([pa.RecordBatch.from_pylist([r.asDict() for r in state.orderBy("uid").collect()])]), bins, [0.0], O.Squared(), one)
    place.g, place.h, place.drawn = g[:, None], h[:, None], np.ones(n, bool)
    assert B.grown(place.search, [(g.sum(), h.sum(), float(n))], bins, one, 0)[0].gain == pytest.approx(tree.gain)
    allowed = None
    if params.columns < 1:
        allowed = np.random.default_rng([one.seed, 0]).choice(5, 2, replace=False)
    want = splits_by_force(x, g, h, params, allowed)
    if want is None or want[0] <= params.min_gain:
        assert tree.feature == [-1]
        return
    assert np.isclose(tree.gain[0], want[0])
    batch = B.Rows(pa.array(cells, pa.list_(pa.int32())), bins)
    node = batch.nodes([tree])[0]
    left = np.flatnonzero(node == 1)
    sides = [np.isin(np.arange(n), left), ~np.isin(np.arange(n), left)]
    t = [np.sign(g[m].sum()) * max(abs(g[m].sum()) - params.l1, 0) for m in sides]
    assert np.isclose(sum(a * a / (h[m].sum() + params.l2) for a, m in zip(t, sides)) - splits_root(g, h, params), want[0])
    assert np.allclose([tree.value[1], tree.value[2]], [-one.step * a / (h[m].sum() + params.l2) for a, m in zip(t, sides)])


def splits_root(g, h, params):
    t = np.sign(g.sum()) * max(abs(g.sum()) - params.l1, 0)
    return t * t / (h.sum() + params.l2)


def test_trees_keep_to_depth_and_leaves(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 4))
    y = np.sin(3 * x[:, 0]) + x[:, 1] * x[:, 2]
    model = B.fit(B_rows := frame(spark, x, y), "y", O.Squared(), B.Params(rounds=5, depth=4, leaves=6, step=0.3))
    assert len(model.rounds) == 5
    for (tree,) in model.rounds:
        assert sum(f < 0 for f in tree.feature) <= 6

        def depth(node):
            return 0 if tree.feature[node] < 0 else 1 + max(depth(tree.left[node]), depth(tree.left[node] + 1))

        assert depth(0) <= 4
    losses = [t for _, t, _ in model.history]
    assert all(b < a for a, b in zip(losses, losses[1:]))
    scored = model.transform(B_rows).select("y", "prediction").toPandas()
    assert np.isclose(((scored["y"] - scored["prediction"]) ** 2).mean(), losses[-1])
    wide = B.fit(B_rows, "y", O.Squared(), B.Params(rounds=60, depth=5, step=0.2))
    assert wide.history[-1][1] < 0.1 * np.var(y)


def test_softmax_learns_classes_and_stops(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 5))
    y = (x[:, 0] > 0) + 2 * (x[:, 1] + 0.3 * x[:, 2] > 0)
    rows = frame(spark, x, y, held=(rng.uniform(size=600) < 0.2).tolist(), other=rng.integers(0, 3, 600).tolist())
    model = B.fit(rows, "y", O.Softmax(4), B.Params(rounds=40, step=0.3, rows=0.9, columns=0.8, patience=5), held="held")
    losses = [t for _, t, _ in model.history]
    assert all(b < a for a, b in zip(losses, losses[1:]))
    scored = model.transform(rows).where("held").select("y", "prediction", "probability").toPandas()
    assert (scored["y"] == scored["prediction"]).mean() > 0.85
    assert all(np.isclose(p.toArray().sum(), 1) for p in scored["probability"])
    noise = B.fit(rows, "other", O.Softmax(3), B.Params(rounds=200, step=0.3, patience=5), held="held")
    assert len(noise.rounds) < 20 and len(noise.history) < 40  # nothing to learn: stopped early, best rounds kept
    constant = B.fit(rows.withColumn("one", F.lit(1.0)), "one", O.Softmax(3), B.Params(rounds=3))
    assert {r["prediction"] for r in constant.transform(rows).collect()} == {1.0}


def test_weights_count(spark):
    x, y = [[0.0]] * 10 + [[1.0]] * 10, [0] * 9 + [1] + [1] * 10
    plain = B.fit(frame(spark, x, y), "y", O.Logistic(), B.Params(rounds=30, step=0.5, l2=0.0))
    heavy = B.fit(frame(spark, x, y, w=[1.0] * 9 + [81.0] + [1.0] * 10), "y", O.Logistic(), B.Params(rounds=30, step=0.5, l2=0.0), weight="w")
    p, q = (m.transform(frame(spark, x[:1], y[:1])).first()["probability"][1] for m in (plain, heavy))
    assert abs(p - 0.1) < 0.02 and abs(q - 0.9) < 0.02


def test_saved_model_scores_alike(spark, tmp_path):
    from pasarlens.sources.model_store import load_model

    rng = np.random.default_rng(5)
    x = rng.normal(size=(80, 3))
    rows = frame(spark, x, (x[:, 0] > 0).astype(int) + (x[:, 1] > 0))
    model = B.fit(rows, "y", O.Softmax(3), B.Params(rounds=4), names=["a", "b", "c"])
    model.write().overwrite().save(f"{tmp_path}/m")
    model.write().overwrite().save(f"{tmp_path}/m")
    again = load_model(spark, f"{tmp_path}/m")
    assert again.names == ["a", "b", "c"] and again.uid == model.uid and list(again.history) == list(model.history)
    a, b = ([r["probability"] for r in m.transform(rows).orderBy("id").collect()] for m in (model, again))
    assert a == b
    assert np.isclose(sum(model.featureImportances.toArray()), 1) and model.featureImportances[2] < 0.2
    assert model.transform(rows.limit(0)).count() == 0
    with pytest.raises(ValueError):
        B.fit(rows.limit(0), "y", O.Softmax(3))


def ranking(spark, rng, n_queries):
    """Rows that are sure to be of some use, and rows of which a quarter is the best: NDCG wants those first."""
    rows = []
    for q in range(n_queries):
        for _ in range(20):
            bold = rng.uniform() < 0.5
            y = 3 * (rng.uniform() < 0.25) if bold else 1
            rows.append((len(rows), q, float(y), Vectors.dense([float(bold) + 0.2 * rng.normal(), rng.normal(), q % 7])))
    return spark.createDataFrame(rows, ["log_id", "query_id", "relevance", "features"])


def test_lambdas_rank_better_than_centred_relevance(spark):
    from pasarlens.models import ranker

    rng = np.random.default_rng(6)
    rows = ranking(spark, rng, 300)
    train, test = rows.where("query_id < 200"), rows.where("query_id >= 200")
    params = B.Params(rounds=20, depth=2, step=0.1, min_rows=50)
    gains = (0, 1, 3, 7)

    def ndcg(model):
        scored = model.transform(test).select("log_id", "query_id", "relevance", "prediction")
        return ndcg_of(scored, gains)

    listwise = B.fit(train, "relevance", O.LambdaRank(gains, truncation=20), params, query="query_id")
    moved = ranker.centred(train.select("log_id", "query_id", "relevance"), "query_id", ["relevance"], "log_id")
    above = moved.select("log_id", F.col("relevance").alias("above"), "weight").join(train.select("log_id", "features"), "log_id")
    pointwise = B.fit(above, "above", O.Squared(), params, weight="weight")
    assert ndcg(listwise) > ndcg(pointwise) + 0.02


@pytest.mark.parametrize("kind", ["rows", "classes", "queries", "hot queries"])
def test_many_partitions_give_the_model_of_one_task(spark, monkeypatch, kind):
    monkeypatch.setattr(B, "STAGE_ROUNDS", 2)
    rng = np.random.default_rng(7)
    if "queries" in kind:
        rows, label, query, objective = ranking(spark, rng, 12), "relevance", "query_id", O.LambdaRank(truncation=5, hot_rows=10 if "hot" in kind else None)
    else:
        x = rng.normal(size=(200, 4)).round(2)
        rows = frame(spark, x, (x[:, 0] > 0) + (x[:, 1] > x[:, 2]), held=(np.arange(200) % 5 == 0).tolist())
        label, query, objective = "y", None, O.Softmax(3) if kind == "classes" else O.Squared()
    params = B.Params(rounds=3, depth=3, step=0.3, rows=0.8)
    held = None if query else "held"
    one = B.fit(rows, label, objective, params, held=held, query=query)
    many = B.fit(rows, label, objective, params, held=held, query=query, part_cells=250)
    assert len(one.rounds) == len(many.rounds) == 3
    for a, b in zip(one.rounds, many.rounds):
        assert [(t.feature, t.cut) for t in a] == [(t.feature, t.cut) for t in b]
        assert all(np.allclose(s.value, t.value) for s, t in zip(a, b))
    assert all(np.allclose([v or 0 for v in a], [v or 0 for v in b]) for a, b in zip(one.history, many.history))


def ndcg_of(scored, gains, k=3):
    found = scored.toPandas().sort_values(["query_id", "prediction", "log_id"], ascending=[True, False, True])
    values = []
    for _, q in found.groupby("query_id"):
        g = np.array(gains)[q["relevance"].astype(int)]
        d = 1 / np.log2(np.arange(2, k + 2))
        best = (np.sort(g)[::-1][:k] * d[: len(g)]).sum()
        values.append((g[:k] * d[: len(g)]).sum() / best if best else 1.0)
    return float(np.mean(values))


@pytest.mark.parametrize("params", [B.Params(depth=5, min_rows=3), B.Params(depth=4, l1=0.2, rows=0.7, columns=0.5), B.Params(depth=6, leaves=9)], ids=["plain", "drawn", "leaves"])
@pytest.mark.parametrize("classes", [1, 3])
def test_columns_give_the_trees_of_cells(monkeypatch, params, classes):
    monkeypatch.setattr(B, "CACHE_ROWS", 64)
    rng = np.random.default_rng(5)
    n, params = 500, B.Params(**{**params.__dict__, "rounds": 6, "step": 0.3})
    x = np.stack([rng.normal(size=n), rng.integers(-2, 3, n), np.zeros(n), rng.normal(size=n) * rng.integers(0, 2, n)], axis=1)
    bins = B.Bins([sorted(set(np.quantile(c, np.arange(1, 32) / 32)))[:-1] for c in x.T])
    y = (x[:, 0] > 0).astype(int) + (x[:, 1] > x[:, 3])
    rows = []
    for i, v in enumerate(x):
        c = bins.entries(np.arange(4), v)
        cells = [int(e) for e in c[c - bins.first != bins.zero]]
        rows.append({"uid": i, "query": 0, "y": float(y[i]), "w": 1.0 + i % 2, "held": i % 7 == 0, "entries": cells})
    kinds = pa.schema([("uid", pa.int64()), ("query", pa.int64()), ("y", pa.float64()), ("w", pa.float64()), ("held", pa.bool_()), ("entries", pa.list_(pa.int32()))])
    parts = [pa.RecordBatch.from_pylist(rows[a : a + 150], kinds) for a in range(0, n, 150)]
    objective = O.Softmax(3) if classes == 3 else O.Squared()
    told = [list(B.boosted(kind(iter(parts), bins, [0.0] * objective.width, objective, params), bins, params)) for kind in (B.InColumns, B.InTask)]
    assert len(told[0]) == len(told[1]) > 3
    for (a, *one), (b, *two) in zip(*told):
        assert [(t.feature, t.cut) for t in a] == [(t.feature, t.cut) for t in b]
        assert all(np.allclose(s.value, t.value) for s, t in zip(a, b)) and np.allclose(one, two)


def test_few_features_need_no_passes(spark, monkeypatch):
    monkeypatch.setattr(B, "PART_CELLS", 100)
    x = np.random.default_rng(6).normal(size=(200, 4))
    rows = frame(spark, x, x[:, 0] > 0)
    assert B.binned(rows, "y", O.Logistic()).parts == 1
    monkeypatch.setattr(B, "TASK_CELLS", 799)
    assert B.binned(rows, "y", O.Logistic()).parts > 1


@pytest.mark.parametrize(
    "params", [B.Params(depth=5, min_rows=3), B.Params(depth=4, l1=0.2, rows=0.7, columns=0.5), B.Params(depth=6, leaves=9, min_rows=20, l2=0.0)], ids=["plain", "drawn", "rows"]
)
@pytest.mark.parametrize("classes", [1, 3])
def test_cells_by_leaf_give_the_trees_of_cells(monkeypatch, params, classes):
    monkeypatch.setattr(B, "CACHE_ROWS", 64)
    rng = np.random.default_rng(8)
    n, width, params = 400, 90, B.Params(**{**params.__dict__, "rounds": 6, "step": 0.3})
    x = rng.normal(size=(n, width)) * (rng.uniform(size=(n, width)) < rng.uniform(0.0, 0.4, width))
    x[:, 0], x[5] = -np.abs(rng.normal(size=n)), 0.0  # a column without zeros but one, a row without cells
    bins = B.Bins([sorted({0.0, *np.quantile(c, np.arange(1, 16) / 16)})[:-1] for c in x.T])
    y = (x[:, 0] > -0.6).astype(int) + (x[:, 1] + x[:, 2:12].sum(axis=1) > 0)
    rows = []
    for i, v in enumerate(x):
        c = bins.entries(np.arange(width), v)
        rows.append({"uid": i, "query": 0, "y": float(y[i]), "w": 1.0 + i % 2, "held": i % 7 == 0, "entries": [int(e) for e in c[c - bins.first != bins.zero]]})
    kinds = pa.schema([("uid", pa.int64()), ("query", pa.int64()), ("y", pa.float64()), ("w", pa.float64()), ("held", pa.bool_()), ("entries", pa.list_(pa.int32()))])
    parts = [pa.RecordBatch.from_pylist(rows[a : a + 150], kinds) for a in range(0, n, 150)]
    objective = O.Softmax(3) if classes == 3 else O.Squared()
    told = [list(B.boosted(kind(iter(parts), bins, [0.0] * objective.width, objective, params), bins, params)) for kind in (B.InCells, B.InTask)]
    assert len(told[0]) == len(told[1]) > 3 and any(len(t.feature) > 3 for t in told[0][1][0])
    for (a, *one), (b, *two) in zip(*told):
        assert [(t.feature, t.cut) for t in a] == [(t.feature, t.cut) for t in b]
        assert all(np.allclose(s.value, t.value) for s, t in zip(a, b)) and np.allclose(one, two)


def test_texts_need_no_passes(spark, monkeypatch):
    monkeypatch.setattr(B, "PART_CELLS", 1000)
    x = np.random.default_rng(9).normal(size=(60, 100))
    rows = frame(spark, x, x[:, 0] > 0)
    assert B.binned(rows, "y", O.Logistic()).parts == 1
    params = B.Params(rounds=3, depth=3, min_rows=5)
    one, many = B.fit(rows, "y", O.Logistic(), params), B.fit(rows, "y", O.Logistic(), params, part_cells=1000)
    for (a,), (b,) in zip(one.rounds, many.rounds, strict=True):
        assert (a.feature, a.cut) == (b.feature, b.cut) and np.allclose(a.value, b.value)
    monkeypatch.setattr(B, "TASK_CELLS", 5000)
    assert B.binned(rows, "y", O.Logistic()).parts > 1


@pytest.mark.parametrize("weighted", [False, True], ids=["even", "weighted"])
def test_few_bins_are_summed_together(monkeypatch, weighted):
    monkeypatch.setattr(B, "CACHE_ROWS", 256)
    rng = np.random.default_rng(10)
    n, sizes = 6000, [2, 40, 3, 1, 16, 5]
    bins = B.Bins([list(map(float, range(s - 1))) for s in sizes])
    x = np.stack([rng.integers(0, s, n) for s in sizes], axis=1)
    y = x[:, 1] % 7 + 2.0 * x[:, 0] * x[:, 4] + rng.normal(size=n)
    cells = [[int(c) for c in (bins.first + v)[v != bins.zero]] for v in x]
    batch = pa.RecordBatch.from_pydict({
        "uid": np.arange(n), "query": np.zeros(n, int), "y": y, "w": 1.0 + weighted * rng.integers(0, 2, n),
        "held": np.arange(n) % 9 == 0, "entries": pa.array(cells, pa.list_(pa.int32())),
    })
    params, objective = B.Params(rounds=4, depth=5, rows=0.8, columns=0.8, min_rows=5, step=0.3), O.Squared()
    rows = B.InColumns(iter([batch]), bins, [0.0], objective, params)
    assert len(rows.groups(1)) < len(rows.groups(1_000)) == len(sizes)
    rows.advance([], 0)
    rows.node[0] = rng.integers(0, 4, n)
    allowed = np.array([True, True, False, True, True, True])
    sums = rows.cells(0, {1: 1, 3: 0}, allowed, 4)
    for node, place in ((1, 1), (3, 0)):
        for f in range(len(sizes)):
            mine = rows.drawn & (rows.node[0] == node) & allowed[f]
            for got, weight in zip(sums[:, f, place], (rows.g[:, 0], rows.h[:, 0], np.ones(n))):
                assert np.allclose(got, np.bincount(x[mine, f], weight[mine], minlength=len(got)))
    told = [list(B.boosted(kind(iter([batch]), bins, [0.0], objective, params), bins, params)) for kind in (B.InColumns, B.InTask)]
    for (a, *one), (b, *two) in zip(*told, strict=True):
        assert [(t.feature, t.cut) for t in a] == [(t.feature, t.cut) for t in b]
        assert np.allclose(one, two)


@pytest.mark.parametrize("width", [4, 90], ids=["columns", "cells"])
@pytest.mark.parametrize("classes", [1, 3])
def test_processes_of_a_task_give_its_trees(width, classes):
    rng = np.random.default_rng(11)
    n, params = 700, B.Params(rounds=6, depth=5, min_rows=3, rows=0.8, columns=0.7, step=0.3)
    x = rng.normal(size=(n, width)) * (rng.uniform(size=(n, width)) < rng.uniform(0.1, 0.6, width))
    x[3] = 0.0
    bins = B.Bins([sorted({0.0, *np.quantile(c, np.arange(1, 16) / 16)})[:-1] for c in x.T])
    y = (x[:, 0] > 0).astype(int) + (x[:, 1] > x[:, 3])
    rows = []
    for i, v in enumerate(x):
        c = bins.entries(np.arange(width), v)
        rows.append({"uid": i, "query": 0, "y": float(y[i]), "w": 1.0 + i % 2, "held": i % 7 == 0, "entries": [int(e) for e in c[c - bins.first != bins.zero]]})
    kinds = pa.schema([("uid", pa.int64()), ("query", pa.int64()), ("y", pa.float64()), ("w", pa.float64()), ("held", pa.bool_()), ("entries", pa.list_(pa.int32()))])
    parts = [pa.RecordBatch.from_pylist(rows[a : a + 150], kinds) for a in range(0, n, 150)]
    objective = O.Softmax(3) if classes == 3 else O.Squared()
    given = bins, [0.0] * objective.width, objective, params
    alone, shared = (B.InColumns, B.SharedColumns) if width == 4 else (B.InCells, B.SharedCells)
    place = shared(iter(parts), *given, 3)
    assert len(place.team.processes) == 3
    told = [list(B.boosted(rows, bins, params)) for rows in (place, alone(iter(parts), *given))]
    place.close()
    assert len(told[0]) == len(told[1]) > 3 and any(len(t.feature) > 3 for t in told[0][1][0])
    for (a, *one), (b, *two) in zip(*told):
        assert [(t.feature, t.cut) for t in a] == [(t.feature, t.cut) for t in b]
        assert all(np.allclose(s.value, t.value) for s, t in zip(a, b)) and np.allclose(one, two)


def test_a_large_table_is_trained_on_by_processes(spark, monkeypatch):
    x = np.random.default_rng(12).normal(size=(300, 4))
    ready = B.binned(frame(spark, x, x[:, 0] + x[:, 1] > 0), "y", O.Logistic())
    params = B.Params(rounds=4, depth=3)
    one = B.train(ready, O.Logistic(), params)
    monkeypatch.setattr(B, "HELPER_CELLS", (400, 400))
    made = []
    monkeypatch.setattr(B, "cores", lambda session: made.append(1) or 3)
    many = B.train(ready, O.Logistic(), params)
    assert ready.cells == 1200 and made
    for (a,), (b,) in zip(one.rounds, many.rounds, strict=True):
        assert (a.feature, a.cut) == (b.feature, b.cut) and np.allclose(a.value, b.value)


def test_what_fails_in_a_process_fails_the_task():
    from pasarlens.models.team import Team

    class Member:
        def __init__(self, batches):
            self.rows = sum(b.num_rows for b in batches)

        def counted(self):
            return self.rows

        def broken(self):
            raise ValueError("told by the member")

    batch = pa.RecordBatch.from_pydict({"x": list(range(7))})
    team = Team(3, lambda number, batches: Member(batches))
    team.given([batch, batch], dealt=True)
    assert sum(team.each("counted")) == 14
    with pytest.raises(RuntimeError, match="told by the member"):
        team.each("broken")
    team.close()
    everyone = Team(2, lambda number, batches: Member(batches))
    everyone.given([batch], dealt=False)
    assert everyone.each("counted") == [7, 7]
    everyone.close()

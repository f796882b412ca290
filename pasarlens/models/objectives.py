"""What boosting minimises: gradients, Hessians and losses by row, and by query for ranking."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pasarlens.operators.topk import topk

# The ranking objective handles queries above this many rows, and above this share of all rows, in parts.
HOT_ROWS = 100_000
HOT_SHARE = 10_000
SMALL = 1e-16


class Objective:
    """Pointwise by default: a row's gradient depends on that row alone."""

    width = 1
    classes = 0
    by_query = False  # whether the rows of a query are needed together

    def start(self, rows: DataFrame) -> list[float]:
        """The margins before the first tree."""
        return [0.0] * self.width

    def marked_hot(self, rows: DataFrame, n_rows: int) -> tuple[DataFrame, list]:
        return rows, []

    def context(self, rows: DataFrame, hot: list) -> object:
        return None

    def batches(self, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return parts

    def gradients(self, margins: np.ndarray, row: dict[str, np.ndarray], context: object):
        raise NotImplementedError

    def answers(self, margins: np.ndarray) -> np.ndarray:
        return margins

    def described(self) -> dict:
        return {"kind": type(self).__name__}


class Squared(Objective):
    def start(self, rows: DataFrame) -> list[float]:
        return [rows.agg(F.sum(F.col("w") * F.col("y")) / F.sum("w")).first()[0] or 0.0]

    def gradients(self, margins, row, context):
        off = margins[:, 0] - row["y"]
        return (row["w"] * off)[:, None], row["w"][:, None].copy(), row["w"] * off * off, row["w"]


class Logistic(Objective):
    """Two classes, 0 and 1."""

    classes = 2

    def start(self, rows: DataFrame) -> list[float]:
        share = rows.agg(F.sum(F.col("w") * F.col("y")) / F.sum("w")).first()[0] or 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return [float(np.log(share / (1 - share)))]

    def gradients(self, margins, row, context):
        m, y, w = margins[:, 0], row["y"], row["w"]
        p = 1 / (1 + np.exp(-np.clip(m, -500, 500)))
        loss = np.maximum(m, 0.0) + np.log1p(np.exp(-np.abs(m))) - y * m
        return (w * (p - y))[:, None], (w * np.maximum(p * (1 - p), SMALL))[:, None], w * loss, w

    def answers(self, margins):
        p = 1 / (1 + np.exp(-np.clip(margins[:, 0], -500, 500)))
        return np.stack([1 - p, p], axis=1)


class Softmax(Objective):
    """Any number of classes, 0 to ``classes`` - 1: one tree per class and round on multinomial residuals."""

    def __init__(self, classes: int):
        self.classes = self.width = classes

    def start(self, rows: DataFrame) -> list[float]:
        found = {int(r["y"]): r["w"] for r in rows.groupBy("y").agg(F.sum("w").alias("w")).collect()}  # one row per class
        weights = np.array([max(found.get(k, 0.0), 1e-9) for k in range(self.classes)])
        return list(map(float, np.log(weights / weights.sum())))

    def gradients(self, margins, row, context):
        p = self.answers(margins)
        hit = np.zeros_like(p)
        at = np.arange(len(p)), row["y"].astype(int)
        hit[at] = 1.0
        w = row["w"][:, None]
        # the diagonal of the Hessian, doubled as the classes' margins move against each other
        return w * (p - hit), w * np.maximum(2 * p * (1 - p), SMALL), -row["w"] * np.log(np.maximum(p[at], 1e-300)), row["w"]

    def answers(self, margins):
        e = np.exp(margins - margins.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def described(self):
        return {"kind": "Softmax", "classes": self.classes}


class LambdaRank(Objective):
    """Listwise ranking: pairs of a query, each weighted by the NDCG its exchange would move.

    NDCG counts the first ``truncation`` places, so an exchange of two rows behind them moves nothing:
    every row meets the rows on the first places only, and the pairs of a query grow with its rows
    and not with their square.  The loss is one minus the mean NDCG of the queries.  Queries without a
    relevant row have no pairs and count as 1.

    A query with very many rows lies in many partitions.  Its first rows are found by a ranking in
    parts and handed to the tasks; what they get from the other rows is summed over the tasks.
    """

    by_query = True

    def __init__(self, gains: Sequence[float] = (0, 1, 3, 7), truncation: int = 30, hot_rows: int | None = None):
        self.gains, self.truncation, self.hot_rows = [float(x) for x in gains], truncation, hot_rows

    def described(self):
        return {"kind": "LambdaRank", "gains": self.gains, "truncation": self.truncation, "hot_rows": self.hot_rows}

    def discount(self, places: np.ndarray) -> np.ndarray:
        return np.where(places < self.truncation, 1 / np.log2(np.maximum(places, 0) + 2.0), 0.0)

    def gain(self, y: np.ndarray) -> np.ndarray:
        return np.array(self.gains)[y.astype(int)]

    def ideal(self, y: np.ndarray) -> float:
        best = np.sort(self.gain(y))[::-1][: self.truncation]
        return float((best * self.discount(np.arange(len(best)))).sum())

    # -------------------------------------------------------------- one query

    def pairs(self, top: dict, s: np.ndarray, gain: np.ndarray, places: np.ndarray, ideal: float):
        """Gradient and Hessian of the rows at ``places`` and of the first rows, from the pairs of both.

        ``top`` has the score, gain and place of the first rows; a pair counts where the first row
        stands before the other one.
        """
        worse = top["gain"][:, None] - gain[None, :]
        before = top["place"][:, None] < places[None, :]
        moved = np.abs(worse) * np.abs(self.discount(top["place"])[:, None] - self.discount(places)[None, :]) / ideal
        sign = np.sign(worse)
        # p: the chance the model gives to the wrong order
        p = 1 / (1 + np.exp(np.clip(sign * (top["s"][:, None] - s[None, :]), -500, 500)))
        delta = np.where(before, moved, 0.0)
        push, curve = sign * p * delta, p * (1 - p) * delta
        return push.sum(axis=0), curve.sum(axis=0), -push.sum(axis=1), curve.sum(axis=1)

    def of_query(self, s: np.ndarray, y: np.ndarray, uid: np.ndarray):
        """Gradient, Hessian and NDCG of a whole query."""
        gain, ideal = self.gain(y), self.ideal(y)
        g, h = np.zeros(len(s)), np.zeros(len(s))
        if not ideal:
            return g, h, 1.0
        order = np.lexsort((uid, -s))
        place = np.empty(len(s), np.int64)
        place[order] = np.arange(len(s))
        first = order[: self.truncation]
        top = {"s": s[first], "gain": gain[first], "place": place[first]}
        step = max(1, 4_000_000 // max(1, len(first)))
        for at in range(0, len(s), step):
            some = slice(at, at + step)
            g_row, h_row, g_top, h_top = self.pairs(top, s[some], gain[some], place[some], ideal)
            g[some] += g_row
            h[some] += h_row
            g[first] += g_top
            h[first] += h_top
        return g, h, float((top["gain"] * self.discount(top["place"])).sum() / ideal)

    # -------------------------------------------------------------- queries in a partition

    def batches(self, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by query; batches end where a query ends."""
        rest: list[pa.RecordBatch] = []
        for batch in parts:
            if not batch.num_rows:
                continue
            query = batch.column("query").to_numpy()
            start = int(np.searchsorted(query, query[-1]))
            if start or (rest and rest[-1].column("query")[0].as_py() != query[0]):
                whole = [*rest, batch.slice(0, start)] if start else rest
                yield pa.concat_batches([b for b in whole if b.num_rows])
                rest = []
            rest.append(batch.slice(start))
        if rest:
            yield pa.concat_batches(rest)

    def gradients(self, margins, row, context):
        s, query, uid, y = margins[:, 0], row["query"], row["uid"], row["y"]
        g, h, loss, loss_w = (np.zeros(len(s)) for _ in range(4))
        edges = np.flatnonzero(np.r_[True, query[1:] != query[:-1], True])
        for a, z in zip(edges[:-1], edges[1:]):
            some = slice(a, z)
            known = (context or {}).get(int(query[a]))
            if known is None:
                g[some], h[some], ndcg = self.of_query(s[some], y[some], uid[some])
                loss[a], loss_w[a] = 1 - ndcg, 1.0
            else:
                g[some], h[some], ndcg, told = self.of_part(known, s[some], y[some], uid[some])
                if told is not None:
                    loss[a + told], loss_w[a + told] = 1 - ndcg, 1.0
        return g[:, None], np.maximum(h, SMALL)[:, None], loss, loss_w

    # -------------------------------------------------------------- queries in many partitions

    def marked_hot(self, rows, n_rows):
        limit = max(HOT_ROWS, n_rows // HOT_SHARE) if self.hot_rows is None else self.hot_rows
        sizes = rows.groupBy("query").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit).select("query")
        hot = sorted(r["query"] for r in sizes.collect())  # fewer than HOT_SHARE
        # the weight marks their rows for the deal: a ranking has no other use for it
        return rows.withColumn("w", F.when(F.col("query").isin(hot), -1.0).otherwise(1.0)), hot

    def context(self, rows, hot):
        """Of every hot query: its first rows, its ideal value, and what the other rows give the first ones."""
        mine = rows.where(F.col("query").isin(hot)).select("query", "uid", "y", F.col("margins")[0].alias("s"))
        tops = topk(mine, ["query"], [F.desc("s"), F.asc("uid")], self.truncation).collect()
        grades = mine.groupBy("query", "y").agg(F.count(F.lit(1)).alias("n")).collect()  # grades are few
        found: dict[int, dict] = {}
        for q in hot:
            first = sorted((r for r in tops if r["query"] == q), key=lambda r: r["rank"])
            best = sorted(((r["y"], min(r["n"], self.truncation)) for r in grades if r["query"] == q), key=lambda r: -self.gains[int(r[0])])
            y = np.array([r["y"] for r in first], float)
            ideal = self.ideal(np.repeat([b[0] for b in best], [b[1] for b in best]))
            top = {"s": np.array([r["s"] for r in first], float), "gain": self.gain(y), "place": np.arange(len(first))}
            uid = np.array([r["uid"] for r in first], np.int64)
            found[q] = {"top": top, "uid": uid, "ideal": ideal, "g": np.zeros(len(first)), "h": np.zeros(len(first))}

        def given(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, np.ndarray] = {}
            for batch in parts:
                column = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("query", "uid", "y", "s")}
                for q in np.unique(column["query"]):
                    known, at = found[int(q)], column["query"] == q
                    _, _, g_top, h_top = self.others(known, column["s"][at], column["y"][at], column["uid"][at])
                    total[int(q)] = total.get(int(q), 0.0) + np.stack([g_top, h_top])
            flat = [(q, i, float(t[0, i]), float(t[1, i])) for q, t in total.items() for i in range(t.shape[1])]
            columns = list(zip(*flat)) if flat else [[]] * 4
            kinds = (pa.int64(), pa.int32(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["query", "i", "g", "h"])

        sums = mine.mapInArrow(given, "query long, i int, g double, h double").groupBy("query", "i").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
        for r in sums.collect():  # hot queries times first places
            found[r["query"]]["g"][r["i"]], found[r["query"]]["h"][r["i"]] = r["g"], r["h"]
        return found

    def others(self, known: dict, s: np.ndarray, y: np.ndarray, uid: np.ndarray):
        """Pairs of the first rows with rows behind them; for the first rows themselves nothing."""
        if not known["ideal"]:
            zero = np.zeros(len(known["uid"]))
            return np.zeros(len(s)), np.zeros(len(s)), zero, zero
        behind = ~np.isin(uid, known["uid"])
        places = np.where(behind, self.truncation, -1)  # -1: before all, so no pair counts
        return self.pairs(known["top"], s, self.gain(y), places, known["ideal"])

    def of_part(self, known: dict, s: np.ndarray, y: np.ndarray, uid: np.ndarray):
        """Gradient and Hessian of some rows of a hot query; its NDCG where its first row lies."""
        g, h, _, _ = self.others(known, s, y, uid)
        top, ndcg = known["top"], 1.0
        if known["ideal"]:
            g_row, h_row, g_top, h_top = self.pairs(top, top["s"], top["gain"], top["place"], known["ideal"])
            g_first, h_first = g_row + g_top + known["g"], h_row + h_top + known["h"]
            at = {int(u): i for i, u in enumerate(known["uid"])}
            for j in np.flatnonzero(np.isin(uid, known["uid"])):
                g[j], h[j] = g_first[at[int(uid[j])]], h_first[at[int(uid[j])]]
            ndcg = float((top["gain"] * self.discount(top["place"])).sum() / known["ideal"])
        leader = np.flatnonzero(uid == known["uid"][0])
        return g, h, ndcg, int(leader[0]) if len(leader) else None


def objective_of(described: dict) -> Objective:
    """The objective a saved model was trained for."""
    kinds = {c.__name__: c for c in (Squared, Logistic, Softmax, LambdaRank)}
    return kinds[described["kind"]](**{k: v for k, v in described.items() if k != "kind"})

"""Quality rules: hashed n-grams, trusted target against raw corpus.

Two multinomials over hashed byte n-grams are counted: one over every document, one over all
documents labelled as good.  A document's score is the mean log ratio of its n-grams, so its length
does not matter.  The threshold is calibrated on all good documents, each scored by the target
without its own n-grams, and then decides every document.  Fixed rules on words, lines and repetition come
first.  Only the counts (``BUCKETS`` numbers each) and the threshold pass through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pasarlens.llm.common import attach, lean_batches, packed, stage
from pasarlens.operators.ranking import rank_cuts

BUCKETS = 1 << 16
GRAM = 4
# The threshold lies as far below this quantile of trusted documents as that lies below their median.
TRUSTED_QUANTILE = 0.001
MIN_WORDS = 50
MOST_REPEATED = 50  # per cent of the words
CHUNK = 1 << 20
SYMBOLS = "#*$%&|<>"


def gram_buckets(text: bytes) -> Iterator[np.ndarray]:
    """Bucket of every byte n-gram, a chunk at a time, so that a very long text needs no more memory."""
    for start in range(0, len(text) - GRAM + 1, CHUNK):
        part = np.frombuffer(text[start : start + CHUNK + GRAM - 1], np.uint8).astype(np.uint64)
        n = len(part) - GRAM + 1
        code = np.zeros(n, np.uint64)
        for k in range(GRAM):
            code = (code << np.uint64(8)) | part[k : k + n]
        yield ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.int64)


def gram_counts(docs: DataFrame) -> np.ndarray:
    """Counts of all buckets over the texts of ``docs``; every task adds up its own part first."""

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(BUCKETS, np.int64)
        for part in parts:
            for text in part["text"]:
                for buckets in gram_buckets((text or "").encode("utf-8")):
                    total += np.bincount(buckets, minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": some.astype(np.int32), "n": total[some]})

    summed = docs.select("text").mapInPandas(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(BUCKETS, np.int64)
    for row in summed.collect():  # BUCKETS rows at most
        counts[row["bucket"]] = row["n"]
    return counts


def text_facts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = text.encode("utf-8").split()  # bytes split at ASCII white space only
    n = len(words)
    white = sum(map(text.count, " \t\n\x0b\x0c\r"))
    symbols = sum(map(text.count, SYMBOLS))
    seen: set[str] = set()
    dup_lines = 0
    for line in text.split("\n"):
        if line in seen:
            dup_lines += 1
        elif line.strip(" \t\n\x0b\x0c\r"):
            seen.add(line)
    repeated = 0
    if n > 3:
        ids: dict[bytes, int] = {}
        codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
        pairs = np.unique(codes[:-1] * len(ids) + codes[1:], return_inverse=True)[1]
        _, which, times = np.unique(pairs[:-1] * len(ids) + codes[2:], return_inverse=True, return_counts=True)
        starts = np.flatnonzero(times[which] > 1)
        inside = np.zeros(n, bool)
        for k in range(3):
            inside[starts + k] = True
        repeated = int(inside.sum())
    return n, len(text) - white, symbols, dup_lines, repeated


def fails(facts: tuple[int, int, int, int, int]) -> bool:
    """The fixed rules."""
    n, repeated = facts[0], facts[4]
    return n < MIN_WORDS or 100 * repeated > MOST_REPEATED * n


@dataclass(frozen=True)
class Model:
    weights: np.ndarray | None  # log ratio by bucket; none: no labelled documents
    threshold: float


def judged(text: Column, model: Model) -> Column:
    """Struct of the facts, ``base_failed``, ``score`` and ``kept`` of a text."""
    weights = None if model.weights is None else model.weights.astype(np.float32)
    threshold = model.threshold

    @F.pandas_udf(
        "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, score double, kept boolean"
    )
    def judge(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            facts = text_facts(text)
            failed = fails(facts)
            score = 0.0
            if weights is not None:
                total, grams = 0.0, 0
                for buckets in gram_buckets((text or "").encode("utf-8")):
                    total += float(weights[buckets].sum(dtype=np.float64))
                    grams += len(buckets)
                score = total / grams if grams else 0.0
            rows.append((*facts, failed, score, not failed and (weights is None or score >= threshold)))
        return pd.DataFrame(
            rows,
            columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"],
        )

    return judge(text)


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    return np.log((target + 1) / (target.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))


def score_without_own(text: Column, target: np.ndarray, raw: np.ndarray) -> Column:
    """Score of a text that ``target`` has counted, by the target without it; null if it fails the fixed rules."""
    base = np.log((raw + 1) / (raw.sum() + BUCKETS))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            facts = text_facts(text)
            own = np.zeros(BUCKETS, np.int64)
            for buckets in gram_buckets((text or "").encode("utf-8")):
                own += np.bincount(buckets, minlength=BUCKETS)
            if fails(facts):
                out.append(None)
                continue
            some, n = np.flatnonzero(own), own.sum()
            others = np.log((target[some] - own[some] + 1) / (target.sum() - n + BUCKETS)) - base[some]
            out.append(float((own[some] * others).sum() / n) if n else 0.0)
        return pd.Series(out, dtype="float64")

    return score(text)


def quantile(rows: DataFrame, column: str, share: float, n: int) -> float:
    """As ``percentile`` of the ``n`` values of ``column``; counting passes, so no task holds them all."""
    at = share * (n - 1)
    low, everything = int(at), F.lit(True)
    cuts = rank_cuts(rows, F.col(column), F.col("at"), [(everything, k) for k in sorted({low, min(low + 1, n - 1)})])
    return cuts[0].value + (at - low) * (cuts[-1].value - cuts[0].value)


def fit(docs: DataFrame, labels: DataFrame, held_out: int | None = None) -> Model:
    """Count both multinomials over all their documents and calibrate the threshold on all good ones.

    A caller may hold a number of good documents out instead: then the target is counted from the
    others, and those calibrate the threshold.
    """
    good = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0) & F.col("doc_id").isNotNull()
    ids = stage(labels.where(good).select(F.col("doc_id").alias("good_id")).distinct(), "trusted")
    texts, same = docs.select("doc_id", "text"), F.col("doc_id") == F.col("good_id")
    trusted = stage(attach(texts, ids, same, ids.count(), "left_semi"), "trusted")
    if held_out is None:
        counted = trusted
    else:
        half = F.pmod(F.xxhash64(F.lit("half"), "good_id"), F.lit(2)) != 0
        held = stage(ids.where(half).orderBy(F.xxhash64("good_id"), "good_id").limit(held_out), "trusted")
        counted = trusted.join(F.broadcast(held), same, "left_anti")
    target = gram_counts(counted)
    if not target.sum():
        return Model(None, 0.0)
    raw = gram_counts(docs)
    weights = log_ratio(target, raw)
    if held_out is None:
        scores = trusted.select(score_without_own(F.col("text"), target, raw).alias("score"))
    else:
        judge = judged(F.col("text"), Model(weights, 0.0)).alias("j")
        scores = trusted.join(F.broadcast(held), same, "left_semi").select(judge).where(~F.col("j.base_failed")).select("j.score")
    scores = stage(scores.dropna().withColumn("at", F.monotonically_increasing_id()), "trusted")
    n = scores.count()
    if not n:
        return Model(weights, -np.inf)
    low, middle = (quantile(scores, "score", share, n) for share in (TRUSTED_QUANTILE, 0.5))
    return Model(weights, 2 * low - middle)


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc, j`` for every row: the row, and the struct of facts and verdict (see ``judged``).

    Null texts count as empty; they and all texts under 50 words or with over half of their words
    in repeated 3-word windows fail the fixed rules.  Others are kept if their score reaches the
    threshold.  Labels with null or repeated ids are ignored or counted once; without good labels
    the fixed rules decide alone.  Repeated rows are judged alike.  An empty table stays empty.
    """
    model = fit(lean_batches(docs), labels)
    return packed(docs).select("doc", judged(F.col("doc.text"), model).alias("j"))

"""Harmonic packing: pieces of about one k-th of the capacity go k to a sequence.

Class k holds the lengths in (capacity / (k + 1), capacity / k].  A document longer than the
capacity gives whole sequences first.  A length that fills its class badly (more than ``slack`` of
the capacity would be padding) gives up its head at the length that fills the next class exactly,
and the rest is classed again: the rest of class k is shorter than capacity / (k * (k + 1)), so a
document is cut a few times at most.

Every worker fills the sequences of each class with exactly k pieces of its own rows, without
looking at other workers.  It keeps less than one sequence per class; what is left over meets in
fewer workers, class by class again, until one worker has all of it.  What that one cannot fill,
fewer pieces than one sequence per class holds, is bounded by the capacity alone; there the classes are mixed.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pasarlens.llm.common import lean_batches, stage
from pasarlens.llm.packing import best_fit, word_ids

CAPACITY = 4096
SLACK = 0.02
# Leftover pieces that one worker takes.
ITEMS = 100_000


def cuts_of(length: int, capacity: int = CAPACITY, slack: float = SLACK) -> list[int]:
    """Lengths of a document's pieces, in their order."""
    found = [capacity] * (length // capacity)
    rest = length % capacity
    while rest:
        k = capacity // rest
        if capacity - k * rest <= slack * capacity:
            found.append(rest)
            break
        head = capacity // (k + 1)
        found.append(head)
        rest -= head
    return found


def pieces_of(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, slack: float) -> DataFrame:
    """Stored ``uid, doc_id, doc_tokens, start, length, ids_crc32``; ``uid`` numbers the pieces."""
    end = np.array([end_id], "<u4")

    @F.pandas_udf("struct<doc_tokens:long,pieces:array<struct<start:long,length:long,ids_crc32:long>>>")
    def cut(texts: pd.Series) -> pd.DataFrame:
        totals, out = [], []
        for found in word_ids(tokenizer).of(texts):
            ids = np.concatenate([found, end]).tobytes()
            at, pieces = 0, []
            for size in cuts_of(len(ids) // 4, capacity, slack):
                pieces.append({"start": at, "length": size, "ids_crc32": zlib.crc32(ids[4 * at : 4 * (at + size)])})
                at += size
            totals.append(at)
            out.append(pieces)
        return pd.DataFrame({"doc_tokens": pd.Series(totals, dtype="int64"), "pieces": pd.Series(out, dtype=object)})

    told = lean_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), cut("text").alias("c"))
    cut_up = told.select("doc_id", "c.doc_tokens", F.explode("c.pieces").alias("p")).select("doc_id", "doc_tokens", "p.*")
    # the numbers are frozen by the written table; a repeated task before that gives the same ones or none
    return stage(cut_up.withColumn("uid", F.monotonically_increasing_id()), "harmonic-pieces")


def placed(rows: pd.DataFrame, bins: np.ndarray, done: bool) -> pd.DataFrame:
    """Rows in the order of their bins; a bin is named by the first piece in it."""
    sizes = rows["length"].to_numpy()
    starts = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]])
    counts = np.diff(np.append(starts, len(rows)))
    before = np.cumsum(sizes) - sizes
    return rows.assign(
        sequence_id=np.repeat(rows["uid"].to_numpy()[starts], counts),
        offset=before - np.repeat(before[starts], counts),
        done=done,
    )


def fill_classes(parts: Iterator[pd.DataFrame], capacity: int) -> Iterator[pd.DataFrame]:
    """Whole sequences of every class; at the end what is left, fewer than k pieces of class k."""
    left: pd.DataFrame | None = None
    for part in parts:
        rows = part if left is None else pd.concat([left, part], ignore_index=True)
        if not len(rows):
            continue
        kind = capacity // rows["length"].to_numpy()
        order = np.argsort(kind, kind="stable")
        rows, kind = rows.iloc[order], kind[order]
        starts = np.flatnonzero(np.r_[True, kind[1:] != kind[:-1]])
        counts = np.diff(np.append(starts, len(rows)))
        place = np.arange(len(rows)) - np.repeat(starts, counts)
        whole = place < np.repeat(counts // kind[starts] * kind[starts], counts)
        if whole.any():
            # bins of one class follow each other, and those of the next class have other numbers
            number = place // kind + np.repeat(starts, counts)
            yield placed(rows[whole], number[whole], True)
        left = rows[~whole]
    if left is not None and len(left):
        yield left.assign(sequence_id=left["uid"], offset=0, done=False)


def fill_mixed(parts: Iterator[pd.DataFrame], capacity: int) -> Iterator[pd.DataFrame]:
    """The last leftovers: first the classes once more, then the largest pieces first, any class together."""
    rest = []
    for rows in fill_classes(parts, capacity):
        if rows["done"].all():
            yield rows
        else:
            rest.append(rows)
    if rest:
        rows = pd.concat(rest, ignore_index=True)
        bins, _ = best_fit(rows["length"].to_numpy(), capacity)
        order = np.argsort(bins, kind="stable")
        yield placed(rows.iloc[order], bins[order], True)


def harmonic_pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = 2,
    slack: float = SLACK,
    items: int = ITEMS,
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` for every piece.

    Each document's ids end with ``end_id``; each id is in one piece, and sequences hold at most
    ``capacity`` ids, without gaps from offset 0.  Null and empty texts are one piece of one id.
    Rows are told apart by number, so repeated rows and null ids are packed each on their own, and
    documents of equal length keep the order of the table.  A very long text is cut into many full
    sequences.  An empty table gives an empty result.  Other columns are not looked at.
    """
    fields = "doc_id long, doc_tokens long, start long, length long, ids_crc32 long, uid long"
    schema = f"{fields}, sequence_id long, offset long, done boolean"
    now = pieces_of(docs, tokenizer, capacity, end_id, slack)
    every: DataFrame | None = None
    parts = 0  # the first round takes the table as it lies
    while True:
        step = fill_mixed if parts == 1 else fill_classes
        dealt = now.repartition(parts, "uid") if parts else now
        filled = stage(dealt.mapInPandas(lambda p, step=step: step(p, capacity), schema), "harmonic")
        done = filled.where("done")
        every = done if every is None else every.unionByName(done)
        if parts == 1:
            break
        now = filled.where(~F.col("done")).drop("sequence_id", "offset", "done")
        waiting = now.count()
        if not waiting:
            break
        # each worker leaves fewer pieces than its share: the number of workers falls in every round
        fewer = -(-waiting // items)
        parts = max(1, min(fewer, parts // 2) if parts else fewer)
    return every.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")

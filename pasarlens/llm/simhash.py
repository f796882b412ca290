"""SimHash near-duplicates: fingerprints that differ in few bits share a block.

A fingerprint of 64 bits is cut into ``blocks`` pieces.  If two fingerprints differ in
``distance`` bits, at most that many pieces differ, so they agree on some choice of
``blocks - distance`` pieces: with 6 and 3 there are 20 choices, each a key of about 32 bits, long
enough to keep chance meetings rare.  Distinct fingerprints (not documents) are dealt by these
keys, and the Hamming distance is verified inside a bucket.  A bucket gives a spanning forest of
its links, never all its pairs; a bucket above ``BUCKET`` fingerprints is cut into chunks, and
every pair of chunks is a bucket of its own, so no task holds more than two chunks and no link is
lost.  Components of the links give the groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pasarlens.llm.common import lean_batches, stage
from pasarlens.llm.components import connected_components
from pasarlens.operators.skew import join_stats

BITS = 64
# Fingerprints of one bucket that are compared in one go.
BUCKET = 4096
_hash = partial(xxhash.xxh64_intdigest, seed=42)


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """Hashes of the word shingles, repeats included; a text of fewer words is one shingle."""
    words = (text or "").encode("utf-8").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < shingle:
        shingles = iter([b" ".join(words)])
        count = 1
    else:
        shingles = map(b" ".join, zip(*[words[k:] for k in range(shingle)]))
        count = len(words) - shingle + 1
    return np.fromiter(map(_hash, shingles), np.uint64, count)


def fingerprint(text: str | None, shingle: int) -> int:
    """SimHash of the word shingles, repeats included, as a signed 64-bit number."""
    hashes = shingle_hashes(text, shingle)
    count = len(hashes)
    if not count:
        return 0
    ones = np.zeros(BITS, np.int64)
    for start in range(0, count, 4096):
        rows = hashes[start : start + 4096].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.int64)[0])


def fingerprint_of(text: Column, shingle: int = 3) -> Column:
    """Fingerprints of a column of texts.  A text without words has fingerprint zero."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return of(text)


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """Stored ``doc_id, fp`` of every row."""
    return stage(lean_batches(docs).select("doc_id", fingerprint_of(F.col("text"), shingle).alias("fp")), "fingerprints")


def _forest(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the (unsigned) fingerprints within ``distance``; linear memory."""
    found, rest = [], fps
    while len(rest) > 1:
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            at = front.pop()
            near = np.bitwise_count(rest ^ at) <= distance
            if near.any():
                met = rest[near]
                found += [(int(at), int(x)) for x in met]
                front += list(met)
                rest = rest[~near]
    return found


def links_in_buckets(parts: Iterator[pd.DataFrame], distance: int) -> Iterator[pd.DataFrame]:
    """Rows sorted by bucket; a bucket may go on in the next batch."""
    keys = ["choice", "key", "low", "high"]
    rest: pd.DataFrame | None = None

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        same = (rows[keys].to_numpy()[1:] == rows[keys].to_numpy()[:-1]).all(axis=1)
        starts = np.flatnonzero(np.concatenate([[True], ~same]))
        sizes = np.diff(np.append(starts, len(rows)))
        fps = rows["fp"].to_numpy().view(np.uint64)  # bits of a signed number would be those of its absolute value
        twos = starts[sizes == 2]
        near = np.bitwise_count(fps[twos] ^ fps[twos + 1]) <= distance
        a, b = list(fps[twos[near]]), list(fps[twos[near] + 1])
        for start, size in zip(starts[sizes > 2], sizes[sizes > 2]):
            for x, y in _forest(fps[start : start + size], distance):
                a.append(x)
                b.append(y)
        return pd.DataFrame({"a": np.array(a, np.uint64).view(np.int64), "b": np.array(b, np.uint64).view(np.int64)})

    for rows in parts:
        rows = rows if rest is None else pd.concat([rest, rows], ignore_index=True)
        if not len(rows):
            continue
        last = rows[keys].iloc[-1]
        open_ = (rows[keys] == last).all(axis=1).to_numpy()
        first_open = int(np.argmax(open_))
        rest = rows.iloc[first_open:].reset_index(drop=True)
        if first_open:
            yield links(rows.iloc[:first_open])
    if rest is not None and len(rest):
        yield links(rest)


def close_links(distinct: DataFrame, distance: int = 3, blocks: int = 6, bucket: int = BUCKET) -> DataFrame:
    """Links ``a, b`` with the same components as all pairs of ``distinct(fp)`` within ``distance``."""
    edges = [round(BITS * k / blocks) for k in range(blocks + 1)]
    pieces = [((1 << edges[k + 1]) - 1) ^ ((1 << edges[k]) - 1) for k in range(blocks)]
    masks = [sum(chosen) for chosen in combinations(pieces, blocks - distance)]
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]
    dealt = F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed])).alias("choice", "key")
    rows = distinct.select("fp", dealt)
    hot = stage(rows.groupBy("choice", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket), "hot")
    alone = F.struct(F.lit(0).alias("low"), F.lit(0).alias("high"))
    if hot.isEmpty():
        rows = rows.select("choice", "key", alone.alias("pair"), "fp")
    else:
        chunks = F.ceil(F.col("n") / bucket).cast("int")
        own = F.pmod(F.xxhash64("fp"), chunks).cast("int")
        pairs = F.transform(
            F.sequence(F.lit(0), chunks - 1),
            lambda j: F.struct(F.least(own, j).alias("low"), F.greatest(own, j).alias("high")),
        )
        rows = rows.join(hot, ["choice", "key"], "left").select(
            "choice", "key", F.explode(F.when(F.col("n").isNull(), F.array(alone)).otherwise(pairs)).alias("pair"), "fp"
        )
    keyed = rows.select("choice", "key", "pair.low", "pair.high", "fp")
    order = ["choice", "key", "low", "high"]
    return (
        keyed.repartition(*order)
        .sortWithinPartitions(*order)
        .mapInPandas(lambda parts: links_in_buckets(parts, distance), "a long, b long")
    )


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3, blocks: int = 6) -> DataFrame:
    """``doc_id, fp, component_id, root`` for every row of ``docs``; ``root`` is a fingerprint that names the group.

    Texts are compared by their fingerprints alone; links are transitive.  ``component_id`` is
    the smallest ``doc_id`` of the group.  Null, empty and blank texts have fingerprint zero and
    are grouped like others.  A null ``doc_id`` never names a group unless all ids of it are null;
    rows with such ids still link.  Repeated rows fall into one group; rows that share an id but not
    the text may be in several, with one ``component_id`` and different roots.  An empty table gives an
    empty result.  Other columns are not looked at.
    """
    rows = fingerprints(docs, shingle)
    classes = stage(rows.groupBy("fp").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first")), "classes")
    return with_components(rows, classes, connected_components(close_links(classes.select("fp"), distance, blocks)))


def with_components(rows: DataFrame, classes: DataFrame, roots: DataFrame) -> DataFrame:
    """``doc_id, fp, component_id, root`` of ``rows(doc_id, fp)``, from ``classes(fp, n, first)`` and their roots."""
    rooted = classes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "n", "first", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of_class = rooted.join(named, "root").select("fp", "n", "component_id", "root")
    return join_stats(rows, of_class, ["fp"], "n", ["doc_id"]).select("doc_id", "fp", "component_id", "root")

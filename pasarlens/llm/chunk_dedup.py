"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes of a text; its value depends on the last 32 bytes only.  A chunk
may end behind white space where the hash is small, so chunk borders follow the content: after an
insertion they fall into the same places again.  Where there has been no white space for ``RUN`` bytes,
as in scripts that do not use it, a chunk may end behind any character.  Chunks are compared by digest over the corpus.
Repeated chunks that follow each other make a passage; passages long enough are removed from all
documents but the one with the smallest id.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pasarlens.llm.common import lean_batches, packed, stage

# One of so many white spaces ends a chunk.
EVERY = 5
# Without white space for so many bytes, one of so many characters ends a chunk.
RUN = 64
EVERY_CHARACTER = 16
# A run of characters without white space counts as a word for every so many bytes.
WORD_BYTES = 12
# A passage of repeated chunks has at least so many words.
PASSAGE_WORDS = 16
GEAR = np.array([int.from_bytes(hashlib.sha256(bytes([b])).digest()[:4], "big") for b in range(256)], np.uint32)
WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
BLOCK = 1 << 20
NO_ID = -(1 << 63)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """sum of GEAR[byte] << age over the last 32 bytes, by doubling the window five times."""
    h = GEAR[data]
    for span in (1, 2, 4, 8, 16):
        shifted = h[:-span] << np.uint32(span)
        h[span:] = h[span:] + shifted
    return h


def chunk_ends(text: bytes) -> list[int]:
    """Byte ends of the chunks; the last one is the end of the text.  Blocks bound the memory."""
    behind_white, behind_any = np.uint32((1 << 32) // EVERY), np.uint32((1 << 32) // EVERY_CHARACTER)
    ends: list[int] = []
    for start in range(0, len(text), BLOCK):
        lead = min(start, RUN)
        data = np.frombuffer(text[start - lead : start + BLOCK], np.uint8)
        white, h = WHITE[data], gear_hashes(data)
        cut = white & (h < behind_white)
        met = np.cumsum(white)
        far = np.zeros(len(data), bool)
        far[RUN:] = met[RUN:] == met[:-RUN]  # none among the last RUN bytes
        if far.any():
            follows = np.frombuffer(text[start - lead + 1 : start + BLOCK + 1], np.uint8)
            whole = np.ones(len(data), bool)  # the next byte does not go on with this character
            whole[: len(follows)] = follows & 0xC0 != 0x80
            cut |= far & whole & (h < behind_any)
        ends += (np.flatnonzero(cut[lead:]) + start + 1).tolist()
    if text and (not ends or ends[-1] < len(text)):
        ends.append(len(text))
    return ends


def n_words(chunk: bytes) -> int:
    """Words of a chunk; a long one counts by its bytes."""
    words = chunk.split()
    if not words or max(map(len, words)) < 2 * WORD_BYTES:
        return len(words)
    return sum(max(1, len(w) // WORD_BYTES) for w in words)


def chunks(text: str | None) -> tuple[list[int], list[int]]:
    """Digests (64 bits, white space at the ends apart) and numbers of words of a text's chunks."""
    data = (text or "").encode("utf-8")
    digests, words, start = [], [], 0
    for end in chunk_ends(data):
        chunk = data[start:end].strip()
        digests.append(xxhash.xxh64_intdigest(chunk) - (1 << 63))
        words.append(n_words(chunk))
        start = end
    return digests, words


def passages(repeated: np.ndarray, words: np.ndarray, least: int) -> np.ndarray:
    """Which chunks lie in a run of repeated chunks with at least ``least`` words."""
    inside = np.zeros(len(words), bool)
    marks = np.flatnonzero(np.diff(np.concatenate([[0], repeated.astype(np.int8), [0]])))
    for start, end in zip(marks[::2], marks[1::2]):
        inside[start:end] = words[start:end].sum() >= least
    return inside


def dedup_chunks(docs: DataFrame, passage_words: int = PASSAGE_WORDS) -> DataFrame:
    """Remove repeated passages: one row per row of ``docs`` with

    ``doc`` (the row), ``n_chunks``, ``n_repeated`` (chunks in passages that another document
    holds), ``n_dropped`` (those removed here), ``first_doc_id`` (smallest id among the other
    holders of these passages; null if there are none), ``spans`` (code points of the removed
    parts, ``start:end``, comma-joined) and ``kept`` (the text without them).

    A document is a ``doc_id``: rows that share one are one document, and repeats within a document
    stay.  A passage stays in the document with the smallest id (by chunk).  Chunks without words
    and passages under ``passage_words`` words never count.  A null id is one document below all
    others, a null text counts as empty.  An empty table stays empty.
    """

    @F.pandas_udf("digests array<long>, words array<int>")
    def cut(texts: pd.Series) -> pd.DataFrame:
        found = [chunks(t) for t in texts]
        return pd.DataFrame({"digests": [d for d, _ in found], "words": [w for _, w in found]})

    cut_up = stage(
        lean_batches(docs).select(
            F.coalesce("doc_id", F.lit(NO_ID)).alias("d"),
            F.xxhash64("text").alias("th"),
            F.monotonically_increasing_id().alias("row"),
            cut("text").alias("c"),
        ).select("d", "th", "row", "c.*"),
        "chunks",
    )
    listed = cut_up.select("d", "row", "words", F.posexplode("digests").alias("pos", "digest")).where(
        F.get("words", F.col("pos")) > 0
    )
    # sums within tasks first: a very frequent chunk is one row per task after that
    shared = stage(
        listed.groupBy("digest").agg(F.min("d").alias("first"), F.max("d").alias("other")).where("first != other"), "shared"
    )
    # rows of a frequent chunk may crowd one task here; adaptive execution splits them
    hits = (
        listed.select("digest", "row", "pos")
        .join(shared, "digest")
        .groupBy("row")
        .agg(F.collect_list(F.struct("pos", "first", "other")).alias("_hits"))
        .join(cut_up.select("row", "d", "th"), "row")
        # repeated rows have the same passages: one of them speaks for all
        .groupBy(F.col("d").alias("_id"), F.col("th").alias("_th"))
        .agg(F.first("_hits").alias("_hits"))
    )
    document = F.coalesce("doc.doc_id", F.lit(NO_ID))
    same = (document == F.col("_id")) & (F.xxhash64(F.col("doc.text")) == F.col("_th"))
    joined = packed(docs).join(hits, same, "left")

    @F.pandas_udf("n_chunks long, n_repeated long, n_dropped long, first_doc_id long, spans string, kept string")
    def drop(ids: pd.Series, texts: pd.Series, hit_lists: pd.Series) -> pd.DataFrame:
        out = []
        for own_id, text, found in zip(ids, texts, hit_lists):
            text = text or ""
            data = text.encode("utf-8")
            ends = chunk_ends(data)
            if found is None or not len(found):
                out.append((len(ends), 0, 0, None, "", text))
                continue
            starts = [0, *ends[:-1]]
            words = np.array([n_words(data[a:z]) for a, z in zip(starts, ends)], np.int64)
            repeated, own = words == 0, np.zeros(len(ends), bool)
            partner: dict[int, int] = {}
            for hit in found:
                k = hit["pos"]
                repeated[k], own[k] = True, hit["first"] == own_id
                partner[k] = hit["other"] if own[k] else hit["first"]
            inside = passages(repeated, words, passage_words) & (words > 0)
            dropped = inside & ~own
            others = [p for k, p in partner.items() if inside[k] and p != NO_ID]
            spans: list[list[int]] = []
            kept, at, chars = [], 0, 0
            for k in np.flatnonzero(dropped):
                a, z = starts[k], ends[k]
                before = data[at:a].decode("utf-8")
                gone = len(data[a:z].decode("utf-8"))
                kept.append(before)
                chars += len(before)
                if spans and spans[-1][1] == chars:
                    spans[-1][1] += gone
                else:
                    spans.append([chars, chars + gone])
                chars, at = chars + gone, z
            kept.append(data[at:].decode("utf-8"))
            out.append(
                (len(ends), int(inside.sum()), int(dropped.sum()), min(others, default=None), ",".join(f"{a}:{z}" for a, z in spans), "".join(kept))
            )
        frame = pd.DataFrame(out, columns=["n_chunks", "n_repeated", "n_dropped", "first_doc_id", "spans", "kept"])
        return frame.astype({"first_doc_id": "Int64"})

    return joined.select("doc", drop(document, F.col("doc.text"), F.col("_hits")).alias("r")).select("doc", "r.*")

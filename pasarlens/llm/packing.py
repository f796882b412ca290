"""Best-fit packing of tokenised documents, in a tree of rounds.

Every partition packs its pieces by best fit.  Bins that are nearly full are done; the bins left
over go on as items of the next round, in fewer partitions, where they meet the leftovers of
others.  The rounds end when all leftovers fit one partition, or when a round brings nothing
more (many bins over half full can never be joined); the bins are then done as they are.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pasarlens.llm.common import lean_batches, stage

# Pieces that one task packs at a time, words that one worker remembers, characters it encodes at a time.
ITEMS = 100_000
CACHED_WORDS = 600_000
BATCH_CHARS = 2_000_000
# A word: anything, then marks that the tokenizer splits from letters before them.
WORD_PARTS = r"^(?s:(?P<stem>.*?)(?P<marks>[.,!?;:*&%$#]*))$"


def gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The slices ``flat[start : start + size]``, one after the other."""
    upto = np.cumsum(sizes)
    total = int(upto[-1]) if len(upto) else 0
    return flat[np.arange(total) + np.repeat(starts - (upto - sizes), sizes)]


class Lexicon:
    """Ids of pieces of text that were encoded before, kept as arrays: a few dozen bytes each."""

    def __init__(self) -> None:
        self.pieces = pa.array([], pa.large_string())
        self.flat = np.zeros(0, np.uint32)
        self.starts = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)

    def add(self, pieces: list[str], ids: list[np.ndarray]) -> None:
        sizes = np.array([len(i) for i in ids], np.int64)
        self.pieces = pa.concat_arrays([self.pieces, pa.array(pieces, pa.large_string())])
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.flat = np.concatenate([self.flat, *ids])


class WordIds:
    """Ids of texts by the tokenizer, word by word.

    White space ends every token, so a text's ids are those of its words in a row, and a word is
    looked up once per batch.  Letters are split from the marks behind them, as the tokenizer does;
    new words of letters only are encoded many at a time, and the tokens that end a word tell them apart.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(1 + max(vocabulary.values()), bool)
        for token, k in vocabulary.items():
            self.ends[k] = token.endswith("</w>")
        self.lexicon = Lexicon()

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def learn(self, pieces: list[str]) -> None:
        ids: list[np.ndarray] = []
        for start in range(0, len(pieces), 1000):
            some = pieces[start : start + 1000]
            found = self.encode(" ".join(some))
            stops = np.flatnonzero(self.ends[found]) + 1
            # each piece ends at least one token; more ends than pieces: the tokenizer splits some of them
            ids += np.split(found, stops[:-1]) if len(stops) == len(some) else [self.encode(w) for w in some]
        if pieces:
            self.lexicon.add(pieces, ids)

    def places(self, pieces: pa.Array) -> np.ndarray:
        """Where the lexicon has each piece, after encoding the new ones."""
        at = pc.fill_null(pc.index_in(pieces, value_set=self.lexicon.pieces), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        missing = np.flatnonzero(at < 0)
        if len(missing):
            unknown = pieces.take(pa.array(missing))
            new, first = unknown.unique(), len(self.lexicon.pieces)
            # letters only, or else encoded one by one: such a piece may hold no token, or several
            letters = pc.utf8_is_alpha(new)
            plain, odd = pc.filter(new, letters), pc.filter(new, pc.invert(letters))
            self.learn(plain.to_pylist())
            if len(odd):
                self.lexicon.add(odd.to_pylist(), [self.encode(w) for w in odd.to_pylist()])
            order = pa.concat_arrays([plain, odd])
            at[missing] = first + pc.index_in(unknown, value_set=order).to_numpy(zero_copy_only=False)
        return at

    def of_batch(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of every text."""
        if len(self.lexicon.pieces) > CACHED_WORDS:
            self.lexicon = Lexicon()
        column = pc.replace_substring(pa.array([t or "" for t in texts], pa.large_string()), "\n", " ")
        lists = pc.split_pattern(column, " ")
        coded = lists.values.dictionary_encode()
        words = coded.dictionary
        parts = pc.extract_regex(words, WORD_PARTS)
        stems, marks = (pc.struct_field(parts, k).cast(pa.large_string()) for k in ("stem", "marks"))
        plain = pc.utf8_is_alpha(stems)
        # a word of another kind is one piece; letters are lower-cased as far as the tokenizer surely does so
        heads = pc.if_else(plain, pc.ascii_lower(stems), words)
        tails = pc.if_else(plain, marks, "")
        at = self.places(pa.concat_arrays([heads, tails]))
        pairs = at.reshape(2, -1).T.reshape(-1)
        own_sizes = self.lexicon.sizes[pairs]
        flat = gathered(self.lexicon.flat, self.lexicon.starts[pairs], own_sizes)
        sizes = own_sizes.reshape(-1, 2).sum(axis=1)
        which = coded.indices.to_numpy()
        counts = sizes[which]
        ids = gathered(flat, (np.cumsum(sizes) - sizes)[which], counts)
        upto = np.concatenate([[0], np.cumsum(counts)])[lists.offsets.to_numpy()]
        return [ids[a:z] for a, z in zip(upto[:-1], upto[1:])]

    def of(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """Ids of many texts, about ``BATCH_CHARS`` at a time, so the memory does not follow their number."""
        some: list[str | None] = []
        chars = 0
        for text in texts:
            some.append(text)
            chars += len(text or "")
            if chars >= BATCH_CHARS:
                yield from self.of_batch(some)
                some, chars = [], 0
                pa.default_memory_pool().release_unused()  # else a worker keeps its largest batch
        if some:
            yield from self.of_batch(some)
            pa.default_memory_pool().release_unused()


_words: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One per worker process: its words serve all batches and tasks."""
    if path not in _words:
        _words[path] = WordIds(path)
    return _words[path]


def pieces_of(docs: DataFrame, tokenizer: str, capacity: int, end_id: int = 0) -> DataFrame:
    """Stored ``uid, doc_id, piece, start, length, ids_crc32``; ``uid`` numbers the pieces.

    A document's ids end with ``end_id``; only longer ones are cut, into pieces of ``capacity``.
    """
    end = np.array([end_id], "<u4")

    @F.pandas_udf("array<struct<start:long,length:long,ids_crc32:long>>")
    def cut(texts: pd.Series) -> pd.Series:
        out = []
        for found in word_ids(tokenizer).of(texts):
            ids = np.concatenate([found, end]).tobytes()
            n = len(ids) // 4
            out.append(
                [
                    {"start": k, "length": min(capacity, n - k), "ids_crc32": zlib.crc32(ids[4 * k : 4 * (k + capacity)])}
                    for k in range(0, n, capacity)
                ]
            )
        return pd.Series(out)

    cut_up = lean_batches(docs).select("doc_id", F.posexplode(cut("text")).alias("piece", "p")).select("doc_id", "piece", "p.*")
    # the numbers are frozen by the written table; a repeated task before that gives the same ones or none
    return stage(cut_up.withColumn("uid", F.monotonically_increasing_id()), "pieces")


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and place in the bin of every item, largest items first into the tightest bin."""
    bins = np.empty(len(sizes), np.int64)
    offsets = np.empty(len(sizes), np.int64)
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by room left
    mask, made = 0, 0
    for i in np.argsort(-sizes, kind="stable"):
        size = int(sizes[i])
        fitting = mask >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            k = open_[room].pop()
            if not open_[room]:
                mask &= ~(1 << room)
        else:
            room, k = capacity, made
            made += 1
        bins[i], offsets[i] = k, capacity - room
        if room > size:
            open_[room - size].append(k)
            mask |= 1 << (room - size)
    return bins, offsets


SCHEMA = (
    "uid long, doc_id long, piece int, start long, length long, ids_crc32 long, bin long, offset long, fill long"
)


def pack_partition(parts: Iterator[pd.DataFrame], capacity: int) -> Iterator[pd.DataFrame]:
    """Rows of whole bins; bins become items and are packed into larger ones."""
    frames = [p for p in parts if len(p)]
    if not frames:
        return
    rows = pd.concat(frames, ignore_index=True).sort_values("uid", ignore_index=True)
    keys, first, item = np.unique(rows["bin"].to_numpy(), return_index=True, return_inverse=True)
    sizes = rows["fill"].to_numpy()[first]
    bins, offsets = best_fit(sizes, capacity)
    lead = np.full(bins.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(lead, bins, keys)  # a bin is named by the smallest number in it
    fills = np.bincount(bins, weights=sizes).astype(np.int64)
    rows["offset"] += offsets[item]
    rows["bin"] = lead[bins[item]]
    rows["fill"] = fills[bins[item]]
    yield rows


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, spare: int = 8, items: int = ITEMS
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for every piece.

    Sequences hold at most ``capacity`` ids; offsets in a sequence are gapless from 0.  A bin with
    at most ``spare`` places left is done.  Null and empty texts are one piece of one id.  Rows
    are told apart by number, so repeated rows and null ids are packed each on their own.  An
    empty table gives an empty result.  Other columns are not looked at.
    """
    pieces = pieces_of(docs, tokenizer, capacity, end_id)
    now = pieces.select(
        "uid", F.col("doc_id").cast("long").alias("doc_id"), "piece", "start", "length", "ids_crc32",
        F.col("uid").alias("bin"), F.lit(0).cast("long").alias("offset"), F.col("length").alias("fill"),
    )
    done = [now.where(F.col("fill") >= capacity - spare)]
    now = now.where(F.col("fill") < capacity - spare)
    waiting = now.count()
    while waiting:
        parts = -(-waiting // items)
        packed = stage(
            now.repartition(parts, "bin").mapInPandas(lambda p: pack_partition(p, capacity), SCHEMA), "packed"
        )
        left = packed.where(F.col("fill") < capacity - spare)
        rest = left.select("bin").distinct().count()
        if parts == 1 or rest > 0.9 * waiting:
            done.append(packed)
            break
        done.append(packed.where(F.col("fill") >= capacity - spare))
        now, waiting = left, rest
    every = done[0]
    for more in done[1:]:
        every = every.unionByName(more)
    return every.select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), "offset"
    )

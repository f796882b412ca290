"""Mixing sources to target weights with hash-threshold histograms.

Every document has a fixed 60-bit hash.  A source whose target is b whole copies plus a part
takes all its documents b times and, once more, those with a hash below the source's
threshold.  The threshold comes from histograms: words are summed by source and by the first
15 bits of the hash, the bucket in which the budget ends is found by a running sum, and only
that bucket is looked at again by the next 15 bits.  After four levels the bucket is a single
hash value.  Nothing is sorted but the histograms, and a rerun takes the same documents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pasarlens.llm.common import attach, packed, stage, words_in

LEVEL_BITS = 15
LEVELS = 4
NO_EDGE = -(1 << 60)


def source_targets(
    sizes: DataFrame, weights: Sequence[float], share: float, most: float
) -> DataFrame:
    """Water-filled targets of ``sizes(source, source_size)``.

    Sources in code point order, null last, weigh ``weights`` in turn.  They share ``share``
    times all sizes in proportion; none exceeds ``most`` times its own size, and the excess goes
    to the others by weight.  With the sources ordered by cap / weight that is one level, found at the
    first source where the rest, shared by the weights still open, stays below its cap (from there on
    the same share only falls).
    One row per source is all that meets in one task here.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    turn = F.array(*[F.lit(float(w)) for w in weights])
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before, onward = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    filled = (
        sizes.withColumn("weight", F.element_at(turn, F.pmod(F.row_number().over(ordered) - 1, F.lit(len(weights))) + 1))
        .withColumn("cap", most * F.col("source_size").cast("double"))
        .withColumn("budget", share * F.sum("source_size").over(everything).cast("double"))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("rest", F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("level", F.col("rest") / F.sum("weight").over(onward))
        .withColumn("open", F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(everything))
    )
    shared = F.coalesce(F.col("open") * F.col("weight"), F.col("cap"))
    return filled.select("source", "source_size", F.least("cap", shared).alias("target"))


def document_hash() -> Column:
    """60 bits of the document's id, or of its text if the id is null."""
    name = F.coalesce(F.col("doc.doc_id").cast("string"), F.col("doc.text"), F.lit(""))
    return F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """The narrow stored table the histograms are taken from: ``doc_id, source, size, hash``."""
    return stage(
        packed(docs).select(
            F.col("doc.doc_id").alias("doc_id"),
            F.col("doc.source").alias("source"),
            words_in(F.col("doc.text")).alias("size"),
            document_hash().alias("hash"),
        ),
        "mix",
    )


def limits_of(rows: DataFrame, weights: Sequence[float], share: float, most: float) -> tuple[DataFrame, int]:
    """Per source ``at, source_size, target, whole, limit``, and the number of sources."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, share, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    state = stage(
        targets.withColumn("whole", whole)
        .withColumn("part", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumn("prefix", F.lit(0).cast("long"))
        .withColumn("taken", F.lit(0).cast("long")),
        "budgets",
    )
    n_sources = state.count()
    running = Window.partitionBy("source").orderBy("bucket")
    for level in range(LEVELS):
        shift = LEVEL_BITS * (LEVELS - 1 - level)
        open_ = state.select(F.col("source").alias("at"), "part", "prefix", F.col("taken").alias("already"))
        same = F.col("source").eqNullSafe(F.col("at")) & (F.shiftright("hash", shift + LEVEL_BITS) == F.col("prefix"))
        edges = (
            attach(rows.select("source", "size", "hash"), open_, same, n_sources, "inner")
            .groupBy("source", F.shiftright("hash", shift).alias("bucket"), "part", "already")
            .agg(F.sum("size").alias("words"))
            .withColumn("upto", F.col("already") + F.sum("words").over(running))
            .where(F.col("upto") > F.col("part"))
            .groupBy("source")
            .agg(F.min(F.struct("bucket", "upto", "words")).alias("edge"))
            .select(F.col("source").alias("at"), "edge")
        )
        # a source without an edge takes nothing beyond its whole copies: no prefix matches it
        state = stage(
            state.join(edges, F.col("source").eqNullSafe(F.col("at")), "left").select(
                "source", "source_size", "target", "whole", "part",
                F.coalesce("edge.bucket", F.lit(NO_EDGE)).alias("prefix"),
                F.coalesce(F.col("edge.upto") - F.col("edge.words"), "taken").alias("taken"),
                F.coalesce("edge.words", F.lit(0)).alias("edge_words"),
            ),
            "budgets",
        )
    # the hash at the edge belongs to the mix if that brings the source nearer to its target
    nearer = F.col("taken") + F.col("edge_words") - F.col("part") < F.col("part") - F.col("taken")
    limit = F.col("prefix") + nearer.cast("int")
    return state.select(F.col("source").alias("at"), "source_size", "target", "whole", limit.alias("limit")), n_sources


def mix_sizes(
    docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """What the mix takes of every document: ``doc_id, size, source_size, target, taken``.

    Size is the number of words; null and blank texts have 0.  A source's words end at the
    document nearest to its target, so they miss it by half a document at most (documents of one
    hash go together).  The hash is that of ``doc_id``, or of the text if that is null: repeated
    rows share their fate.  A source without words has target 0 and takes nothing.  A null
    source is a source.  An empty table gives an empty result.
    """
    rows = sized(docs)
    limits, n_sources = limits_of(rows, weights, share, most)
    copies = F.col("whole") + (F.col("hash") < F.col("limit")).cast("int")
    return attach(rows, limits, F.col("source").eqNullSafe(F.col("at")), n_sources).select(
        "doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken")
    )


def mix(
    docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as ``mix_sizes`` takes it.

    Documents without words cost nothing and follow their hash like any other.
    """
    limits, n_sources = limits_of(sized(docs), weights, share, most)
    copies = F.col("whole") + (document_hash() < F.col("limit")).cast("int")
    taken = attach(packed(docs), limits, F.col("doc.source").eqNullSafe(F.col("at")), n_sources)
    repeated = taken.select("doc", F.explode(F.array_repeat(F.lit(0), copies)).alias("copy"))
    return repeated.select("doc.*")

"""From raw documents to packed training sequences: five stages over ``documents``.

Every stage takes (spark, docs, sf_dir) and works on all its predecessor kept, which is written
as Parquet and read again in between.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pasarlens.llm.common import lean_batches, packed, stage
from pasarlens.llm.line_dedup import dedup_lines
from pasarlens.llm.mixing import mix
from pasarlens.llm.packing import pack
from pasarlens.llm.quality import quality_rules
from pasarlens.llm.queries import Query, table, tokenizer_path
from pasarlens.llm.simhash import fingerprint_of, near_duplicates
from pasarlens.operators.skew import join_stats


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality rules keep.

    Null and empty texts have no words and go; repeated rows have one verdict.  An empty table gives
    an empty result.  All columns are kept as they are.
    """
    judged = quality_rules(docs, table(spark, sf_dir, "labels"))
    return judged.where("j.kept").select("doc.*")


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that other documents hold; ``n_chars`` follows the new text.

    A text that changes not at all stays as it is, null included; a document all of whose lines go
    stays with the empty text.  Repeated rows lose the same lines.  An empty table gives an empty result.
    """
    done = dedup_lines(docs)
    changed = F.col("n_dropped") > 0
    new = {"text": F.when(changed, F.col("kept")).otherwise(F.col("doc.text"))}
    new["n_chars"] = F.when(changed, F.length("kept").cast("long")).otherwise(F.col("doc.n_chars"))
    return done.select(*[new.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates by SimHash: the one with the smallest id.

    Rows that share this id and the group are repeats; the first of them by text stays.  Rows that
    share an id but are in different groups are different documents and are judged each by its own
    fingerprint.  Rows without an id stay only for a group that has none with an id, one for each
    group.  Null and empty texts are one group, as they have one fingerprint.  An empty table gives
    an empty result.
    """
    found = stage(near_duplicates(docs), "groups")
    named = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    rows = packed(docs).withColumns({"doc_id": F.col("doc.doc_id"), "text_hash": F.xxhash64("doc.text")})
    ids = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("times"), F.bool_or(F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("names"))
    # one row per id: no bound holds for a broadcast of them
    ids = stage(ids, "ids").hint("merge")
    held = join_stats(rows, ids, ["doc_id"], "times", ["text_hash"], null_safe=True, how="inner", ready=True).where("names")
    held = stage(held.select("doc", "doc_id", "times"), "named")
    single = held.where("times = 1").select("doc")
    # ids of several rows: the row counts only with the fingerprint that is named after the id
    several = lean_batches(held.where("times > 1")).withColumn("fp", fingerprint_of(F.col("doc.text")))
    roots = named.groupBy("doc_id", "fp").agg(F.count(F.lit(1)).alias("times_named"), F.min("root").alias("root"))
    repeats = join_stats(several.withColumn("text_hash", F.xxhash64("doc.text")), roots, ["doc_id", "fp"], "times_named", ["text_hash"], null_safe=True, how="inner")
    # every task keeps one row per group before anything is moved
    chosen = repeats.groupBy("root").agg(F.min_by("doc", F.struct("doc.text", F.to_json("doc"))).alias("doc")).select("doc")
    return single.unionByName(chosen).select("doc.*")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources near their target weights: documents go, stay, or come twice.

    Null and empty texts have size zero and go with the hash of their id; a null source is a source of
    its own; rows that share an id have one fate.  An empty table gives an empty result.
    """
    return mix(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequence and place in it.

    Null and empty texts are one piece of one id; a document that comes twice is packed twice.  An
    empty table gives an empty result.
    """
    return pack(docs, tokenizer_path())


STAGES = [
    ("quality rules", good_documents),
    ("line dedup", without_repeated_lines),
    ("SimHash near-dedup", one_of_each_group),
    ("mixing sources to target weights", mixed),
    ("best-fit packing", packed_sequences),
]

# The quality model, the fingerprints and the tokenizer have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each result is written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stage(docs, name.lower().replace(" ", "-"))
    return docs


PIPELINE = Query("pipeline", run, ORACLE_SQL)

"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

A rotation of the centred vectors is learnt on a bounded sample, alternating between binary codes
and the orthogonal map that fits them best.  The signs of the rotated vectors are the code, cut
into ``TABLES`` substrings.  Two vectors meet if a substring differs in one bit at most; pairs whose
whole codes differ too much are skipped, and the rest is checked with the original vectors in
double precision.  Equal vectors are one class: only classes meet, and copies are counted.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pasarlens.llm.common import stage
from pasarlens.llm.components import connected_components
from pasarlens.operators.skew import join_stats

TABLES = 4
# Share of the pairs right on the threshold that no table may bring together, if their bits differ independently.
MISSED = 0.006
# A substring has at least so many bits, and more for more vectors: buckets stay small.
LEAST_BITS = 16
# The rotation is fitted on at most so many vectors; every vector is indexed.
SAMPLE = 8192
ROUNDS = 30


def learn_rotation(x: np.ndarray, bits: int, seed: int) -> np.ndarray:
    """Principal directions of ``x`` (centred), rotated for balanced codes; (dimensions, bits)."""
    dims = x.shape[1]
    wide = min(bits, dims)
    _, vectors = np.linalg.eigh(x.T @ x)
    axes = vectors[:, ::-1][:, :wide]
    v = x @ axes
    rotation = np.linalg.qr(np.random.default_rng(seed).normal(size=(wide, wide)))[0]
    for _ in range(ROUNDS):
        codes = np.where(v @ rotation >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(v.T @ codes)
        rotation = left @ right
    return axes @ rotation


def learn(sample: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection for ``bits`` bits; with more bits than dimensions, several rotations."""
    mean = sample.mean(axis=0)
    parts, made = [], 0
    while made < bits:
        parts.append(learn_rotation(sample - mean, bits - made, len(parts)))
        made += parts[-1].shape[1]
    return mean, np.concatenate(parts, axis=1)


def tables_for(bits: int, least: float) -> int:
    """Substrings of ``bits`` bits so that pairs with cosine ``least`` agree in one up to a bit, but for ``MISSED``."""
    apart = math.acos(least) / math.pi
    meets = (1 - apart) ** bits + bits * apart * (1 - apart) ** (bits - 1)
    return max(TABLES, math.ceil(math.log(MISSED) / math.log1p(-meets))) if meets < 1 else TABLES


def coded(vector: Column, mean: np.ndarray, projection: np.ndarray, tables: int) -> Column:
    """The substrings of the code of a vector, as longs."""
    dims, bits = projection.shape
    each = bits // tables

    @F.pandas_udf("array<long>")
    def encode(vectors: pd.Series) -> pd.Series:
        x = np.zeros((len(vectors), dims))
        for i, v in enumerate(vectors):
            x[i, : len(v)] = v
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        signs = ((x - mean) @ projection >= 0).reshape(len(x), tables, each)
        return pd.Series(list(signs @ (1 << np.arange(each, dtype=np.int64))))

    return encode(vector)


def differing(a: str, b: str, k: int) -> Column:
    return F.bit_count(F.get(F.col(a), F.lit(k)).bitwiseXOR(F.get(F.col(b), F.lit(k))))


def candidate_pairs(codes: DataFrame, bits: int, tables: int, radius: int) -> DataFrame:
    """``a, b`` (a < b), each pair once, from ``codes(rep, label, code)``."""
    probes = F.concat(
        F.array(F.lit(0).cast("long")), F.transform(F.sequence(F.lit(0), F.lit(bits - 1)), lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i))
    )
    left = codes.select(F.col("rep").alias("a"), F.col("label").alias("la"), F.col("code").alias("ca"), F.posexplode("code").alias("t", "sub"))
    left = left.select("a", "la", "ca", "t", F.explode(F.transform(probes, lambda p: F.col("sub").bitwiseXOR(p))).alias("key"))
    right = codes.select(F.col("rep").alias("b"), F.col("label").alias("lb"), F.col("code").alias("cb"), F.posexplode("code").alias("u", "own"))
    apart = [differing("ca", "cb", k) for k in range(tables)]
    total = sum(apart[1:], apart[0])
    # a pair that meets in several tables counts in the first of them only
    earlier = F.lit(False)
    for k in range(tables - 1):
        earlier = earlier | ((F.col("t") > k) & (apart[k] <= 1))
    met = (F.col("la") == F.col("lb")) & (F.col("t") == F.col("u")) & (F.col("key") == F.col("own"))
    return left.join(right, met & (F.col("a") < F.col("b")) & (total <= radius) & ~earlier).select("a", "b")


def cosine(a: Column, b: Column) -> Column:
    def dot(x: Column, y: Column) -> Column:
        products = F.zip_with(x, y, lambda p, q: F.coalesce(p.cast("double") * q.cast("double"), F.lit(0.0)))
        return F.aggregate(products, F.lit(0.0).cast("double"), lambda s, p: s + p)

    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def usable(vector: Column) -> Column:
    """Not null or zero, every component finite."""
    value = vector.cast("array<double>")
    bad = F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(value, lambda x: x != 0), F.lit(False))


def near_vectors(rows: DataFrame, least: float = 0.98, sample: int = SAMPLE) -> DataFrame:
    """``vec_id, n_links, component_id`` for every row of ``rows(vec_id, embedding, label)``.

    Only vectors with equal labels are compared, by cosine in double precision (shorter vectors
    count as filled up with zeros).  ``n_links`` is the number of other rows linked directly, equal
    vectors included; ``component_id`` is the smallest ``vec_id`` reachable.  Vectors that are null,
    empty, zero or hold null or non-finite components, vectors without a label and rows without
    ``vec_id`` stay alone.  Repeated rows are vectors of their own with one id.  An empty table
    gives an empty result.  Pairs of different vectors may be missed with a small probability.
    """
    good = usable(F.col("embedding")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    marked = stage(
        rows.select("vec_id", "embedding", "label", good.alias("good")).withColumn(
            "same", F.when(F.col("good"), F.sha2(F.concat_ws(",", F.col("label").cast("string"), F.to_json(F.struct("embedding"))), 256))
        ),
        "vectors",
    )
    every = marked.select("vec_id", "same")
    classes = stage(
        marked.where("good").groupBy("same").agg(
            F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("rep"), F.first("label").alias("label"), F.first("embedding").alias("embedding")
        ),
        "classes",
    )
    n_classes, dims = classes.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    if not n_classes:
        return every.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    fitted = np.zeros((min(sample, n_classes), dims))
    for i, row in enumerate(classes.orderBy(F.xxhash64("rep"), "rep", "same").limit(sample).select("embedding").collect()):
        fitted[i, : len(row[0])] = row[0]
    fitted /= np.linalg.norm(fitted, axis=1, keepdims=True)
    bits = max(LEAST_BITS, math.ceil(math.log2(n_classes + 1)))
    tables = tables_for(bits, least)
    mean, projection = learn(fitted, tables * bits)
    # copies of one id but different vectors: classes are told apart by their own number
    keyed = stage(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")
    codes = stage(
        keyed.select(F.col("cls").alias("rep"), "label", coded(F.col("embedding"), mean, projection, tables).alias("code")), "codes"
    )
    # bits differ with probability angle / pi; this radius lies over five deviations above the mean
    share = math.acos(least) / math.pi
    radius = math.ceil(tables * bits * share + 5.5 * math.sqrt(tables * bits * share * (1 - share)))
    vector = keyed.select(F.col("cls"), "embedding")
    links = stage(
        candidate_pairs(codes, bits, tables, radius)
        .join(vector.toDF("a", "va"), "a")
        .join(vector.toDF("b", "vb"), "b")
        .where(cosine(F.col("va"), F.col("vb")) >= least)
        .select("a", "b"),
        "links",
    )
    sizes = keyed.select("cls", "n")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counts = both.join(sizes.toDF("b", "m"), "b").groupBy(F.col("a").alias("cls")).agg(F.sum("m").alias("m"))
    roots = connected_components(links).toDF("cls", "root")
    joined = keyed.select("cls", "same", "n", "rep").join(roots, "cls", "left").join(counts, "cls", "left")
    whole = joined.select("cls", "same", "n", "rep", F.coalesce("root", "cls").alias("root"), F.coalesce("m", F.lit(0)).alias("m"))
    named = whole.groupBy("root").agg(F.min("rep").alias("component_id"))
    of_class = whole.join(named, "root").select("same", "n", (F.col("n") - 1 + F.col("m")).alias("n_links"), "component_id")
    found = join_stats(every, of_class, ["same"], "n", ["vec_id"], null_keys=True)
    return found.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))

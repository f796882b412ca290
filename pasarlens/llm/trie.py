"""The prefix trie of conversations that share their beginnings, from fingerprints alone.

A conversation is rebuilt as the head of its base conversation and the rest of its own turns.  The
rebuilt texts are never formed.  A run of turns has the fingerprint (n, g), g = sum of a_i * B^i
over its turns i = 1..n modulo a prime, for a few bases B at once; a_i comes from a 128-bit hash of
the turn.  Fingerprints are a monoid:

    (m, g) . (n, h) = (m + n, g + B^m * h)        and a run loses a head (m, g) by B^-m.

So the fingerprint of every prefix of a rebuilt conversation is the product of one of the base's
(at most eight) heads and a part of the own run.  The same product joins the parts of a long
conversation that lies in several tasks: each task multiplies its own rows, and one element per
task is carried over.

A node of the trie is a group of equal fingerprints at one depth.  Its rows hold a reference to
their last turn (the class of equal turns) and to the parent's fingerprint; a group is right if all
its rows agree on both, and a class of turns if all its turns have one role and text.  Both are
verified on all rows.  If a check fails, everything is done again with other hashes and bases.

Sums over subtrees need no walk.  The smallest member of a node owns it; a conversation owns the
nodes from some depth on.  A subtree holds all that its members own from its top down, so the sums
are those of its members' totals, less what the owner of the top owns above it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pasarlens.llm.common import stage
from pasarlens.operators.skew import join_stats

PRIME = (1 << 31) - 1
BASES = 4
# Conversations c share the head of c - c % FAMILY; a head has fewer than HEADS turns.
FAMILY = 5
HEADS = 9
# Ids that one piece of an id list holds.
BLOCK_IDS = 50_000
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
G = [f"g{k}" for k in range(BASES)]
E = [f"e{k}" for k in range(BASES)]


def bases(seed: int) -> list[int]:
    return [int(b) for b in np.random.default_rng(seed).integers(1 << 20, PRIME - 1, BASES)]


class Powers:
    """B^n modulo the prime for arrays of n, by digits of 12 bits."""

    def __init__(self, base: int):
        self.tables, b = [], base
        for _ in range(3):
            table = [1]
            for _ in range(4095):
                table.append(table[-1] * b % PRIME)
            self.tables.append(np.array(table, np.int64))
            b = table[-1] * b % PRIME

    def of(self, n: np.ndarray) -> np.ndarray:
        found = self.tables[0][n & 4095]
        found = found * self.tables[1][(n >> 12) & 4095] % PRIME
        return found * self.tables[2][n >> 24] % PRIME


def elements(k1: np.ndarray, k2: np.ndarray) -> list[np.ndarray]:
    """Four numbers below the prime from the 128-bit hash of a turn."""
    return [(x >> shift & PRIME) % PRIME for x in (k1, k2) for shift in (0, 31)]


def multiply_along(parts: Iterator[pd.DataFrame], seed: int) -> Iterator[pd.DataFrame]:
    """Place and products of the rows of each conversation so far, within the task.

    Rows come in the order of conversations and turns; a conversation may go on in the next batch.
    ``e`` is the product before the row, ``g`` the product with it.
    """
    powers = [Powers(b) for b in bases(seed)]
    last, count, so_far = None, 0, [0] * BASES
    for rows in parts:
        if not len(rows):
            continue
        conv = rows["conv_id"].to_numpy()
        starts = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
        sizes = np.diff(np.append(starts, len(conv)))
        place = np.arange(1, len(conv) + 1) - np.repeat(starts, sizes)
        goes_on = conv[0] == last
        if goes_on:
            place[: sizes[0]] += count
        out = {"task": rows["task"], "conv_id": conv, "place": place, "k1": rows["k1"], "k2": rows["k2"], "n_bytes": rows["n_bytes"]}
        for k, a in enumerate(elements(rows["k1"].to_numpy(), rows["k2"].to_numpy())):
            term = a * powers[k].of(place) % PRIME
            upto = np.cumsum(term)  # fewer than 2^32 rows of a batch below 2^31 each
            before = np.repeat(upto[starts] - term[starts], sizes)
            if goes_on:
                before[: sizes[0]] -= so_far[k]
            out[G[k]] = (upto - before) % PRIME
            out[E[k]] = (out[G[k]] - term) % PRIME
            so_far[k] = int(out[G[k]][-1])
        last, count = conv[-1], int(place[-1])
        yield pd.DataFrame(out)


def carried(tails: Sequence, seed: int) -> list[tuple]:
    """What the first conversation of a task brings from the tasks before: its turns and product.

    ``tails`` has one row per task: the first conversation and the element of the last one.
    """
    found, conv, n, g = [], None, 0, [0] * BASES
    for row in sorted(tails, key=lambda r: r["task"]):
        goes_on = row["first"] == conv
        if goes_on:
            found.append((row["task"], conv, n, [pow(b, n, PRIME) for b in bases(seed)], list(g)))
        tail = row["tail"]
        if not (goes_on and tail["conv_id"] == conv):
            n, g = 0, [0] * BASES
        g = [(x + pow(b, n, PRIME) * tail[c]) % PRIME for x, b, c in zip(g, bases(seed), G)]
        n, conv = n + tail["place"], tail["conv_id"]
    return found


def numbered_turns(turns: DataFrame, seed: int) -> DataFrame:
    """Turns with their ``place`` (from 1) in the conversation and the products ``g`` and ``e``.

    Range partitions cut long conversations, so none has to fit a task.
    """
    order = ["conv_id", "turn", "k1", "k2", "tie"]
    dealt = turns.withColumn("tie", F.monotonically_increasing_id())  # equal rows: any order
    dealt = dealt.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order]).sortWithinPartitions(*order)
    fields = ", ".join(f"{c} long" for c in ("conv_id", "place", "k1", "k2", "n_bytes", *G, *E))
    local = stage(
        dealt.select(F.spark_partition_id().alias("task"), "conv_id", "k1", "k2", "n_bytes").mapInPandas(
            lambda parts: multiply_along(parts, seed), f"task int, {fields}"
        ),
        "turns-multiplied",
    )
    tails = local.groupBy("task").agg(F.min("conv_id").alias("first"), F.max(F.struct("conv_id", "place", *G)).alias("tail"))
    more = carried(tails.collect(), seed)  # one row per task
    if not more:
        return local.drop("task")
    brought = turns.sparkSession.createDataFrame(more, "task int, conv_id long, n long, powers array<long>, before array<long>")

    def joined(columns: list[str]) -> list[Column]:
        return [
            F.when(F.col("n").isNull(), F.col(c)).otherwise((F.col("before")[k] + F.col("powers")[k] * F.col(c)) % PRIME).alias(c)
            for k, c in enumerate(columns)
        ]

    return local.join(F.broadcast(brought), ["task", "conv_id"], "left").select(
        "conv_id", (F.col("place") + F.coalesce("n", F.lit(0))).alias("place"), "k1", "k2", "n_bytes", *joined(G), *joined(E)
    )


def fingerprint(parts: list[Column]) -> list[Column]:
    """The residues as two longs."""
    return [F.shiftleft(parts[k], 31).bitwiseOR(parts[k + 1]) for k in range(0, BASES, 2)]


def rebuilt_prefixes(turns: DataFrame, seed: int) -> DataFrame:
    """A row for every prefix of every rebuilt conversation: its fingerprint, that of its parent, its last turn."""
    zeros = F.array(*[F.lit(0).cast("long")] * BASES)
    head = [
        F.max(F.when(F.col("place") == i, F.struct(F.array(*G).alias("g"), "k1", "k2", "n_bytes")))
        for i in range(1, HEADS)
    ]
    convs = stage(
        turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.array(*head).alias("heads")).withColumn(
            "h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
        ),
        "conversations",
    )
    shared = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"), F.col("heads").alias("base_heads"))
    own = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY).join(shared, "base", "left")
    own = own.withColumn("from_base", F.least("h", F.coalesce("base_n", F.lit(0))).cast("int"))

    def run_of(heads: str, count: Column) -> Column:
        return F.when(count > 0, F.element_at(heads, F.greatest(count, F.lit(1)))["g"]).otherwise(zeros)

    # the product of the own turns after the first h is that of all, less the head, times B^(from_base - h)
    inverse = [[pow(b, -i, PRIME) for i in range(HEADS)] for b in bases(seed)]
    gap = (F.col("h") - F.col("from_base")).cast("int") + 1
    told = stage(
        own.select(
            "conv_id", "n", "h", "from_base", "base_heads",
            run_of("base_heads", F.col("from_base")).alias("front"),
            F.when(F.col("n") > F.col("h"), run_of("heads", F.col("h").cast("int"))).otherwise(zeros).alias("lost"),
            F.array(*[F.element_at(F.array(*[F.lit(x).cast("long") for x in table]), gap) for table in inverse]).alias("factor"),
            (F.col("from_base") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("depths"),
        ),
        "rebuilt",
    )
    none = [F.lit(0).cast("long")] * 2
    root = told.select(
        "conv_id", F.lit(0).cast("long").alias("depth"), *[z.alias(c) for z, c in zip(none * 3, ("f1", "f2", "p1", "p2", "k1", "k2"))],
        F.lit(0).cast("long").alias("n_bytes"), (F.col("depths") == 0).alias("ends"),
    )
    at = told.select("conv_id", "depths", "from_base", "base_heads", F.explode(F.expr("if(from_base > 0, sequence(1, from_base), array())")).alias("depth"))
    here, above = F.element_at("base_heads", F.col("depth")), F.when(F.col("depth") > 1, F.element_at("base_heads", F.greatest(F.col("depth") - 1, F.lit(1)))["g"]).otherwise(zeros)
    from_base = at.select(
        "conv_id", F.col("depth").cast("long").alias("depth"),
        *[c.alias(n) for c, n in zip(fingerprint([here["g"][k] for k in range(BASES)]), ("f1", "f2"))],
        *[c.alias(n) for c, n in zip(fingerprint([above[k] for k in range(BASES)]), ("p1", "p2"))],
        here["k1"].alias("k1"), here["k2"].alias("k2"), here["n_bytes"].alias("n_bytes"), (F.col("depth") == F.col("depths")).alias("ends"),
    )
    facts = told.select("conv_id", "n", "h", "from_base", "front", "lost", "factor", "depths")
    after = join_stats(turns, facts, ["conv_id"], "n", ["place"], how="inner", ready=True).where(F.col("place") > F.col("h"))

    def product(columns: list[str]) -> list[Column]:
        return [
            (F.col("front")[k] + F.pmod(F.col(c) - F.col("lost")[k], F.lit(PRIME)) * F.col("factor")[k]) % PRIME
            for k, c in enumerate(columns)
        ]

    depth = F.col("from_base") + F.col("place") - F.col("h")
    from_own = after.select(
        "conv_id", depth.alias("depth"),
        *[c.alias(n) for c, n in zip(fingerprint(product(G)), ("f1", "f2"))],
        *[c.alias(n) for c, n in zip(fingerprint(product(E)), ("p1", "p2"))],
        "k1", "k2", "n_bytes", (depth == F.col("depths")).alias("ends"),
    )
    return stage(root.unionByName(from_base).unionByName(from_own), "prefixes")


def running_sum(rows: DataFrame, group: str, order: str, amount: str, name: str) -> DataFrame:
    """The sum of ``amount`` before a row in its group, by ``order`` (unique in the group).

    Range partitions cut large groups; what a group has in earlier partitions is one row per
    partition border.
    """
    dealt = rows.repartitionByRange(group, order).withColumn("_task", F.spark_partition_id())
    placed = stage(dealt, "running")
    parts = placed.groupBy(group, "_task").agg(F.sum(amount).alias("_sum"))
    several = parts.groupBy(group).agg(F.sort_array(F.collect_list(F.struct("_task", "_sum"))).alias("_parts")).where(F.size("_parts") > 1)
    before = several.select(group, F.posexplode("_parts").alias("_at", "_part"), "_parts").select(
        group, F.col("_part._task").alias("_task"),
        F.aggregate(F.slice("_parts", 1, F.col("_at")), F.lit(0).cast("long"), lambda s, p: s + p["_sum"]).alias("_before"),
    )
    upto = Window.partitionBy("_task", group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum(amount).over(upto), F.lit(0))
    joined = placed.join(F.broadcast(before), ["_task", group], "left")  # at most two rows per partition
    return joined.withColumn(name, F.coalesce("_before", F.lit(0)) + own).drop("_task", "_before")


def id_pieces(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by node and id, as comma-joined pieces of an id list."""
    for rows in parts:
        for start in range(0, len(rows), BLOCK_IDS):
            some = rows.iloc[start : start + BLOCK_IDS]
            keys = some[["depth", "f1", "f2"]].to_numpy()
            starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
            ids = some["conv_id"].to_numpy()
            yield some.iloc[starts][["depth", "f1", "f2"]].assign(
                first=ids[starts], ids=[",".join(map(str, x)) for x in np.split(ids, starts[1:])]
            )


def digests(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of the joined pieces of every node; pieces stream through, none is kept."""
    node, state = None, None
    for rows in parts:
        out = []
        for depth, f1, f2, ids in rows[["depth", "f1", "f2", "ids"]].itertuples(index=False):
            if (depth, f1, f2) == node:
                state.update(b"," + ids.encode())
                continue
            if node is not None:
                out.append((*node, state.hexdigest()))
            node, state = (depth, f1, f2), hashlib.sha256(ids.encode())
        yield pd.DataFrame(out, columns=["depth", "f1", "f2", "ends_sha256"])
    if node is not None:
        yield pd.DataFrame([(*node, state.hexdigest())], columns=["depth", "f1", "f2", "ends_sha256"])


def digests_of_ends(ends: DataFrame) -> DataFrame:
    """``ends_sha256`` of the nodes where conversations end.

    SHA-256 has to see a list in order, so the list of one node is hashed by one task; it gets it as
    pieces that other tasks have sorted and joined, and holds one batch of them at a time.
    """
    order = ["depth", "f1", "f2", "conv_id"]
    sorted_ids = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = stage(sorted_ids.mapInPandas(id_pieces, "depth long, f1 long, f2 long, first long, ids string"), "id-pieces")
    node = ["depth", "f1", "f2"]
    return pieces.repartition(*node).sortWithinPartitions(*node, "first").mapInPandas(
        digests, "depth long, f1 long, f2 long, ends_sha256 string"
    )


def hashed_turns(table: DataFrame, seed: int) -> DataFrame:
    """Stored turns without their texts, with a 128-bit hash of role and text and the bytes of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return stage(
        table.where("conv_id is not null").select(
            F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
            F.xxhash64(F.lit(f"{seed}/1"), role, text).alias("k1"), F.xxhash64(F.lit(f"{seed}/2"), text, role).alias("k2"),
            F.octet_length(text).cast("long").alias("n_bytes"),
        ),
        "turns",
    )


def turns_verified(table: DataFrame, seed: int) -> bool:
    """Whether turns of one hash have one role and text.  Equal turns are combined before they move."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    distinct = table.where("conv_id is not null").select(role.alias("role"), text.alias("text")).distinct()
    keyed = distinct.select(F.xxhash64(F.lit(f"{seed}/1"), "role", "text").alias("k1"), F.xxhash64(F.lit(f"{seed}/2"), "text", "role").alias("k2"))
    return keyed.groupBy("k1", "k2").count().where("count > 1").isEmpty()


def nodes_of(prefixes: DataFrame) -> DataFrame:
    """Stored nodes; ``sound`` says that all rows of the group agree on parent and last turn."""
    same = [F.min(c) == F.max(c) for c in ("p1", "p2", "k1", "k2")]
    return stage(
        prefixes.groupBy("depth", "f1", "f2").agg(
            F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.count_if("ends").alias("n_ends"),
            F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("n_bytes").alias("n_bytes"),
            (same[0] & same[1] & same[2] & same[3]).alias("sound"),
        ),
        "nodes",
    )


def prefix_trie(table: DataFrame, seed: int = 0) -> DataFrame:
    """The nodes of the trie of rebuilt conversations, from rows (conv_id, turn, role, text).

    One row per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null at the
    root), ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    Turns are ordered by ``turn``, null first; equal numbers by a hash of role and text, so repeated
    rows are turns of their own and the order of the table does not matter.  Null role or text is
    the empty text.  Rows without ``conv_id`` belong to no conversation.  A remainder has the sign
    of the id, so -3 has the base 0.  Texts may be of any length; they are read twice and never
    joined up.  An empty table gives an empty result.  Other columns are not looked at.
    """
    while not turns_verified(table, seed):
        seed += 1
    while True:
        prefixes = rebuilt_prefixes(numbered_turns(hashed_turns(table, seed), seed), seed)
        nodes = nodes_of(prefixes)
        if nodes.where("not sound").isEmpty():
            break
        seed += 1
        while not turns_verified(table, seed):
            seed += 1
    key = ["depth", "f1", "f2"]
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("f1"), F.col("p2").alias("f2")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    whole = nodes.join(children, key, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    whole = stage(
        whole.withColumns({
            "weight": F.when(F.col("depth") > 0, (F.col("n_convs") - 1) * F.col("n_bytes")).otherwise(0).cast("long"),
            "leaf": (F.col("n_children") == 0).cast("long"),
        }),
        "nodes",
    )
    # what every conversation owns, and what its members own together
    owned = whole.groupBy("conv_id").agg(
        F.sum("weight").alias("weights"), F.sum("leaf").alias("leaves"), F.min("depth").alias("owns_from"), F.max("depth").alias("depths")
    )
    lengths = owned.withColumn("n_rows", F.col("depths") + 1)
    rows = join_stats(prefixes.select("conv_id", *key), lengths, ["conv_id"], "n_rows", ["depth"], how="inner")
    others = rows.groupBy(*key).agg(F.sum("weights").alias("weights"), F.sum("leaves").alias("leaves"))
    # a leaf is owned at the end, so no owner has one above a node; weights above are taken off
    above = running_sum(whole, "conv_id", "depth", "weight", "above")
    summed = above.join(others, key)
    parents = whole.select(F.col("depth").alias("up"), F.col("f1").alias("u1"), F.col("f2").alias("u2"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("n_below"))
    named = join_stats(summed.withColumn("up", F.col("depth") - 1).withColumnsRenamed({"p1": "u1", "p2": "u2"}), parents.where("n_below > 0"), ["up", "u1", "u2"], "n_below", ["f1", "f2"], null_keys=False)
    ended = digests_of_ends(prefixes.where("ends"))
    return named.join(ended, key, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        F.col("leaves").alias("n_leaves"), (F.col("weights") - F.col("above")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"),
    )

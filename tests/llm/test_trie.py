"""The prefix trie against a trie built turn by turn from rebuilt texts."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pandas as pd
import pytest

from pasarlens.llm import queries as Q
from pasarlens.llm import trie as T

SCHEMA = "conv_id long, turn long, role string, text string, depth long, place long, n long, task int, tie long, k1 long, base long"


def table_of(spark, turns):
    return spark.createDataFrame([(*t, 1, 2, 3, 4, 5, 6, 7) for t in turns], SCHEMA)


def remainder(a, b):
    return a - b * int(a / b)


def trie_by_force(turns, tie):
    """``turns``: (conv_id, turn, role, text); ``tie``: sort key of turns with one number."""
    own = collections.defaultdict(list)
    for conv, turn, role, text in turns:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, tie(role or "", text or ""), (role or "", text or "")))
    own = {c: [x[-1] for x in sorted(rows)] for c, rows in own.items()}
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9
        whole = tuple(own.get(c - remainder(c, 5), [])[:h] + own[c][h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
        ends[whole].append(c)
    children = collections.Counter(n[:-1] for n in members if n)
    leaves, saved = collections.Counter(), collections.Counter()
    for n in members:
        weight = (len(members[n]) - 1) * len(n[-1][1].encode()) if n else 0
        for d in range(len(n) + 1):
            leaves[n[:d]] += not children[n]
            saved[n[:d]] += weight
    return sorted(
        (
            members[n][0], len(n), members[n[:-1]][0] if n else None, len(members[n]), children[n], leaves[n], saved[n],
            hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest(),
        )
        for n in members
    )


def rows_of_trie(frame):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert frame.columns == names
    return sorted((tuple(r) for r in frame.collect()), key=lambda r: (r[0], r[1]))


def by_hash(spark, turns, seed=0):
    """The order of turns with equal numbers: the hash of role and text."""
    distinct = sorted({(r or "", t or "") for _, _, r, t in turns})
    frame = spark.createDataFrame([(1, 1, r, t) for r, t in distinct], "conv_id long, turn long, role string, text string")
    seen = frame.selectExpr("role", "text", f"xxhash64('{seed}/1', role, text) k1", f"xxhash64('{seed}/2', text, role) k2").collect()
    keys = {(r["role"], r["text"]): (r["k1"], r["k2"]) for r in seen}
    return lambda role, text: keys[role, text]


def made_up(seed, n_convs, longest, words=3):
    rng = random.Random(seed)
    turns = []
    for c in range(n_convs):
        for t in range(rng.randint(1, longest)):
            turns.append((c, t, rng.choice(["user", "assistant"]), "é" * rng.randint(0, words)))
    for c in range(n_convs, n_convs + 15):  # copies of one conversation
        turns += [(c, t, "user", "same") for t in range(12)]
    rng.shuffle(turns)
    return turns


AWKWARD = [
    (0, None, None, None), (0, 0, "user", "hi"), (0, 1, "", ""), (0, 1, None, None), (0, 2, "user", "x" * 50_000),
    (1, 5, "user", "hi"), (1, 5, "user", "hi"), (1, 5, "user", "ho"), (2, 0, "us", "erhi"), (2, 0, "user", "hi"),
    (None, 0, "user", "lost"), (None, None, None, None), (7, 0, "a", "b"), (-3, 0, "a", "b"), (-5, 1, "c", "d"), (-8, 0, None, "b"),
    (11, 0, "a", "b"), (13, 0, "a", "b"), (13, 1, "a", "b"), (10**12 + 3, 0, "a", "b"),
]
CASES = {"awkward": AWKWARD, "short": made_up(1, 60, 12, 1), "long": made_up(2, 12, 90), "one": [(4, 0, "user", "hi")]}


@pytest.mark.parametrize("name", CASES)
def test_trie(spark, name):
    turns = CASES[name]
    got = rows_of_trie(T.prefix_trie(table_of(spark, turns)))
    assert got == sorted(trie_by_force(turns, by_hash(spark, turns)), key=lambda r: (r[0], r[1]))


def test_trie_of_no_turns(spark):
    assert T.prefix_trie(table_of(spark, AWKWARD).limit(0)).count() == 0
    assert T.prefix_trie(table_of(spark, [(None, 1, "a", "b")])).count() == 0


def test_one_conversation_in_many_tasks(spark):
    """Small range partitions: a long conversation and its copy lie in several tasks."""
    rng = random.Random(3)
    turns = [(c, t, "user", str(rng.randint(0, 3) if c == 5 else t)) for c in (5, 6, 7, 20, 21) for t in range(400)]
    turns += [(c, t, "user", str(t)) for c in (0, 15) for t in range(3)]
    plain = rows_of_trie(T.prefix_trie(table_of(spark, turns)))
    keep = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        many = T.numbered_turns(T.hashed_turns(table_of(spark, turns), 0), 0)
        assert sorted(r["place"] for r in many.where("conv_id = 6").collect()) == list(range(1, 401))
        got = rows_of_trie(T.prefix_trie(table_of(spark, turns)))
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    assert got == plain == sorted(trie_by_force(turns, by_hash(spark, turns)), key=lambda r: (r[0], r[1]))


def test_products_of_parts_equal_the_whole():
    rng = np.random.default_rng(4)
    n = 5000
    whole = pd.DataFrame({"task": 0, "conv_id": np.sort(rng.integers(0, 4, n)), "k1": rng.integers(-(2**63), 2**63 - 1, n), "k2": rng.integers(-(2**63), 2**63 - 1, n), "n_bytes": 1})
    once = pd.concat(T.multiply_along(iter([whole]), 0), ignore_index=True)
    batched = pd.concat(T.multiply_along(iter([whole[:10], whole[10:10], whole[10:2000], whole[2000:]]), 0), ignore_index=True)
    pd.testing.assert_frame_equal(once, batched)
    a, bases = T.elements(whole["k1"].to_numpy(), whole["k2"].to_numpy()), T.bases(0)
    for k, base in enumerate(bases):  # by definition, for the first conversation
        g = 0
        for i in range(int((whole["conv_id"] == 0).sum())):
            g = (g + int(a[k][i]) * pow(base, i + 1, T.PRIME)) % T.PRIME
            assert once[f"g{k}"][i] == g


def test_colliding_hashes_are_noticed(spark, monkeypatch):
    """Bases of zero make all fingerprints of one depth equal: the check sees it and takes other bases."""
    good = T.bases
    monkeypatch.setattr(T, "bases", lambda seed: [0] * T.BASES if seed == 0 else good(seed))
    monkeypatch.setattr(T, "rebuilt_prefixes", lambda turns, seed, real=T.rebuilt_prefixes: real(turns, seed) if seed else real(turns, 1))
    turns = made_up(5, 20, 6)
    got = rows_of_trie(T.prefix_trie(table_of(spark, turns)))
    assert got == sorted(trie_by_force(turns, by_hash(spark, turns, 1)), key=lambda r: (r[0], r[1]))


def test_long_id_lists_come_in_pieces(spark, monkeypatch):
    ends = spark.range(1000).selectExpr("2L depth", "7L f1", "if(id < 900, 1L, 2L) f2", "999 - id conv_id")
    keep = T.BLOCK_IDS
    try:
        T.BLOCK_IDS = 64
        got = {r["f2"]: r["ends_sha256"] for r in T.digests_of_ends(ends).collect()}
    finally:
        T.BLOCK_IDS = keep
    for f2, ids in ((1, range(100, 1000)), (2, range(100))):
        assert got[f2] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_query_has_the_trie_of_the_table(spark, folder):
    turns = [tuple(r) for r in Q.table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = rows_of_trie(Q.op12_prefix_trie(spark, folder))
    assert got == sorted(trie_by_force(turns, by_hash(spark, turns)), key=lambda r: (r[0], r[1]))

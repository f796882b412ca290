"""Harmonic packing against the tokenizer, and its classes."""

import collections
import zlib

import numpy as np
import pandas as pd
import pytest

from pasarlens.llm import harmonic as H
from pasarlens.llm import queries as Q
from pasarlens.llm.packing import WordIds
from tests.llm.cases import awkward, rows_of


@pytest.mark.parametrize("capacity", [16, 100, 2048, 4096])
@pytest.mark.parametrize("slack", [0.0, 0.02, 0.3])
def test_cuts(capacity, slack):
    for length in range(1, 3 * capacity):
        cuts = H.cuts_of(length, capacity, slack)
        assert sum(cuts) == length and all(0 < c <= capacity for c in cuts)
        rest = [c for c in cuts if c < capacity]
        assert len(rest) <= 6
        for c in rest[:-1]:  # heads fill their class as well as whole numbers can
            assert c == capacity // (capacity // c)
        if rest:
            assert capacity - capacity // rest[-1] * rest[-1] <= slack * capacity or rest[-1] == capacity // (capacity // rest[-1])


def check_sequences(rows, ids_of, times=None, capacity=4096):
    """Every id in one piece, offsets without gaps; the share of padding."""
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(ids_of)
    for doc_id, ids in ids_of.items():
        got = sorted(pieces[doc_id], key=lambda r: r["start"])
        if (times or {}).get(doc_id, 1) == 1:
            at = 0
            for r in got:
                assert r["start"] == at and r["doc_tokens"] == len(ids)
                assert r["ids_crc32"] == zlib.crc32(np.array(ids[at : at + r["length"]], "<u4").tobytes())
                at += r["length"]
            assert at == len(ids)
    padding = 0
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding, len(sequences)


@pytest.fixture(scope="module")
def words():
    return WordIds(Q.tokenizer_path())


def ids_of_rows(words, rows):
    return {r["doc_id"]: [*words.encode(r["text"] or "").tolist(), 2] for r in rows}


@pytest.mark.parametrize("items", [H.ITEMS, 60])
def test_query(spark, folder, words, items):
    docs = Q.table(spark, folder, "documents")
    ids = ids_of_rows(words, docs.collect())
    got = Q.op13_harmonic(spark, folder) if items == H.ITEMS else H.harmonic_pack(docs.repartition(6), Q.tokenizer_path(), items=items)
    padding, used = check_sequences(got.collect(), ids)
    total = sum(map(len, ids.values()))
    assert padding <= 0.02 * total + 4096
    assert used <= 1.02 * total / 4096 + 1


def test_sequences_of_a_class_have_its_count(spark):
    """Full sequences hold k pieces of class k; every worker leaves less than one sequence per class."""
    rng = np.random.default_rng(0)
    sizes = np.concatenate([[c for c in H.cuts_of(int(n))] for n in rng.integers(1, 9000, 3000)])
    rows = pd.DataFrame({"doc_id": 1, "doc_tokens": 1, "start": 0, "length": sizes, "ids_crc32": 0, "uid": np.arange(len(sizes))})
    found = pd.concat(H.fill_classes(iter([rows[:5], rows[5:5], rows[5:900], rows[900:]]), 4096))
    assert sorted(found["uid"]) == list(range(len(sizes)))
    full, left = found[found["done"]], found[~found["done"]]
    kinds = full.assign(k=4096 // full["length"])
    assert (kinds.groupby("sequence_id")["k"].nunique() == 1).all()
    assert (kinds.groupby("sequence_id")["k"].first() == kinds.groupby("sequence_id").size()).all()
    assert (full.groupby("sequence_id")["length"].sum() >= 4096 * (1 - H.SLACK) - 64).all()
    rest = left.groupby(4096 // left["length"]).size()
    assert all(n < k for k, n in rest.items())


def test_awkward(spark, words):
    odd = rows_of(spark, awkward(spark))
    rows = odd.select("doc_id", "text").collect()
    times = collections.Counter(r["doc_id"] for r in rows)
    got = H.harmonic_pack(odd, Q.tokenizer_path()).collect()
    check_sequences(got, ids_of_rows(words, rows), times)
    assert sum(r["length"] for r in got) == sum(len(words.encode(r["text"] or "")) + 1 for r in rows)
    assert [r["length"] for r in got if r["doc_id"] in (1, 2, 3)] == [1, 1, 1]
    assert H.harmonic_pack(odd.limit(0), Q.tokenizer_path()).count() == 0


def test_equal_lengths_and_one_very_long_text(spark, words):
    docs = rows_of(spark, [(i, "the " * 1200, "a") for i in range(40)] + [(99, "the " * 100_000, "a")])
    got = H.harmonic_pack(docs, Q.tokenizer_path()).collect()
    padding, _ = check_sequences(got, ids_of_rows(words, docs.collect()))
    assert padding <= 2 * 4096

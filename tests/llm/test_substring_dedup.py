from __future__ import annotations

import random

import numpy as np
import pytest

from tests.llm.texts import awkward, clashing, documents, prose
from tripline.llm import repeats, substring_dedup
from tripline.llm.substring_dedup import sorted_suffixes, without_repeats


def brute_force(rows: list, length: int = 50) -> list:
    """Every string of every document in one dictionary."""
    rank = {None: float("inf")}
    first: dict[bytes, float] = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        order = rank.get(doc_id, doc_id)
        for k in range(len(data) - length + 1):
            string = data[k : k + length]
            first[string] = min(first.get(string, order), order)
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        order = rank.get(doc_id, doc_id)
        gone = bytearray(len(data))
        for k in range(len(data) - length + 1):
            if first[data[k : k + length]] < order:
                gone[k : k + length] = b"\x01" * length
        spans = sum(1 for k in range(len(data)) if gone[k] and not (k and gone[k - 1]))
        out.append((doc_id, len(data), sum(gone), spans, bytes(b for b, g in zip(data, gone) if not g)))
    return sorted(out, key=repr)


def check(docs) -> None:
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = sorted(((a, b, c, d, bytes(e)) for a, b, c, d, e in without_repeats(docs).collect()), key=repr)
    assert found == brute_force(rows)


def test_awkward_rows(spark):
    check(clashing(documents(spark, awkward())).repartition(5))


def test_awkward_rows_in_small_blocks(spark, monkeypatch):
    """Every document a block of its own, several buckets, and few suffixes at a time."""
    monkeypatch.setattr(substring_dedup, "bucket_count", lambda rows: 7)
    check(documents(spark, awkward()).repartition(30, "text"))


def test_crowded_anchors(spark, monkeypatch):
    """Anchors that more than a few texts share have their strings dealt out one by one."""
    monkeypatch.setattr(repeats, "CROWD", 3)
    monkeypatch.setattr(substring_dedup, "bucket_count", lambda classes: 3)
    passage = " ".join(prose(41, 30))
    shared = [" ".join(prose(50 + k, 12)) + " " + passage + " " + " ".join(prose(90 + k, 9)) for k in range(25)]
    check(documents(spark, awkward() + shared).repartition(6))


def test_empty_tables(spark):
    assert without_repeats(documents(spark, [])).collect() == []
    check(documents(spark, [None, "", None]))


def test_documents(spark, sf_dir):
    check(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def test_lengths_around_the_limit(spark):
    common = " ".join(prose(21, 40))[:60]
    texts = [common] + [f"a{k} " + common[5 : 5 + n] + f" {k}z" for k, n in enumerate((47, 48, 49, 50, 51, 55))]
    check(documents(spark, texts + ["ab" * 25, "ab" * 26, "ab" * 24 + "a", "ba" * 40, "a" * 49, "a" * 50, "a" * 200]))


@pytest.mark.parametrize("seed", range(8))
def test_suffixes_are_sorted(seed):
    """Order and equality against plain sorting, over few letters so that prefixes are long."""
    draw = random.Random(seed)
    unit = "".join(draw.choices("ab", k=draw.choice([3, 30, 200])))
    data = ("".join(draw.choice([unit, unit[:-1], unit + "c"]) for _ in range(30))).encode()
    length, n = 50, len(data) - 50 + 1
    if n < 1:
        return
    padded = np.append(np.frombuffer(data, np.uint8), np.zeros(8, np.uint8))
    group = np.arange(n) % 2
    rows, leaf = sorted_suffixes(padded, np.arange(n), np.sort(group), length)
    group = np.sort(group)
    strings = [(int(group[k]), data[k : k + length]) for k in range(n)]
    expected = sorted(s for s in strings if strings.count(s) > 1)
    assert [strings[k] for k in rows] == expected
    assert [a == b for a, b in zip(leaf, leaf[1:])] == [a == b for a, b in zip(expected, expected[1:])]


def test_three_way_partitions_sort_each_rank():
    """Ranks stay where they are, and inside each the symbols rise: random, equal, rising, falling and organ-pipe ones."""
    from tripline.llm.substring_dedup import _partitioned

    draw = np.random.default_rng(6)
    for round_ in range(60):
        sizes = draw.integers(1, [3, 40, 2000][round_ % 3], 30)
        rank = np.repeat(np.arange(len(sizes)) * 2, sizes)
        groups = []
        for k, n in enumerate(sizes):
            kinds = [draw.integers(0, 2**64, n, np.uint64), draw.integers(0, 3, n).astype(np.uint64), np.arange(n), np.arange(n)[::-1]]
            groups.append(np.asarray([*kinds, np.minimum(np.arange(n), np.arange(n)[::-1])][k % 5], np.uint64))
        symbol = np.concatenate(groups)
        order = _partitioned(symbol, rank)
        assert sorted(order.tolist()) == list(range(len(symbol))) and (rank[order] == rank).all()
        assert (symbol[order] == symbol[np.lexsort((symbol, rank))]).all()
    assert len(_partitioned(np.empty(0, np.uint64), np.empty(0, np.int64))) == 0

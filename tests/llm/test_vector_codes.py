from __future__ import annotations

import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.vectors import awkward, usable, vectors
from tripline.llm import vector_codes
from tripline.llm.vector_codes import compressed, digest


def brute_force(rows: list, positions: int = 4, entries: int = 256, rounds: int = 4) -> list:
    """The rounds in loops over plain integers."""
    whole = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in usable(rows)]
    width = len(whole[0][1]) // positions if whole else 0
    parts = [[v[p * width : (p + 1) * width] for _, v, _ in whole] for p in range(positions)]
    first = sorted(range(len(whole)), key=lambda k: (whole[k][0] is None, whole[k][0] or 0, whole[k][1]))[:entries]
    books = [[own[k] for k in first] for own in parts]

    def nearest(part: list, book: list) -> tuple[int, int]:
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), e) for e, entry in enumerate(book))

    for _ in range(rounds):
        for own, book in zip(parts, books):
            members: dict[int, list] = {}
            for part in own:
                members.setdefault(nearest(part, book)[1], []).append(part)
            for e, some in members.items():
                book[e] = [sum(column) // len(some) for column in zip(*some)]
    found = [[nearest(part, book) for part in own] for own, book in zip(parts, books)]
    text = ",".join(str(x) for book in books for entry in book for x in entry) if whole else ""
    sha = hashlib.sha256(text.encode()).hexdigest()
    errors, by_label = [sum(own[k][0] for own in found) for k in range(len(whole))], Counter()
    for (_, _, label), error in zip(whole, errors):
        by_label[label] += error
    codes = ["".join(f"{own[k][1]:02x}" for own in found) for k in range(len(whole))]
    return sorted(((i, code, error, by_label[label], sha) for (i, _, label), code, error in zip(whole, codes, errors)), key=repr)


def collected(df, **options) -> list:
    return sorted((tuple(row) for row in digest(compressed(df, **options)).collect()), key=repr)


@pytest.mark.parametrize("entries", [256, 5])
def test_awkward_rows(spark, entries, monkeypatch):
    monkeypatch.setattr(vector_codes, "MEMBERS", 40)  # many owners
    rows = awkward(120)
    df = vectors(spark, rows).withColumns({name: F.lit("x") for name in ("row", "cell", "code", "parts", "error")})
    assert collected(df, entries=entries) == brute_force(rows, entries=entries)


def test_few_rows(spark):
    assert collected(vectors(spark, [])) == []
    assert collected(vectors(spark, [(1, None, 1), (2, [math.nan] * 8, None)])) == []
    rows = [(5, [0.25] * 4, None)]
    assert collected(vectors(spark, rows)) == brute_force(rows) == [(5, "00000000", 0, 0, hashlib.sha256(b"256,256,256,256").hexdigest())]


def test_no_rounds(spark):
    rows = awkward(60)
    assert collected(vectors(spark, rows), rounds=0) == brute_force(rows, rounds=0)


def test_large_components_stay_exact(spark):
    rows = [(k, [x * 2.0**10 for x in v], label) for k, v, label in usable(awkward(40))]
    assert max(abs(x) for _, v, _ in rows for x in v) * 1024 > 1 << 19
    assert collected(vectors(spark, rows), entries=7) == brute_force(rows, entries=7)
    larger = [(k, [x * 2.0**7 for x in v], label) for k, v, label in rows]  # beyond what doubles hold exactly
    assert collected(vectors(spark, larger), entries=7) == brute_force(larger, entries=7)


def test_vectors_that_cannot_be_cut(spark):
    with pytest.raises(ValueError, match="components"):
        compressed(vectors(spark, [(1, [0.5] * 8, 1), (2, [0.5] * 4, 1)]))
    with pytest.raises(ValueError, match="components"):
        compressed(vectors(spark, [(1, [0.5] * 6, 1)]))
    with pytest.raises(ValueError, match="64 bits"):
        compressed(vectors(spark, [(1, [-1e30] * 8, 1)]))


def test_only_what_changes_its_entry_moves(spark):
    """Of a reassignment, what keeps its entry stays in its task; what moves goes to the owner of its new entry."""
    import numpy as np

    draw = np.random.default_rng(1)
    parts, books, salts = draw.integers(-500, 500, (300, 4)).astype(np.int32), [draw.integers(-500, 500, (9, 4))], 5
    rows, old = np.arange(300), draw.integers(0, 9, 300).astype(np.uint8)
    cells = vector_codes._cells(0, rows, old, salts)
    blocks = [(cell, tuple(block)) for cell, *block in vector_codes._packed(cells, 0, rows, old, parts)]
    assert {cell for cell, _ in blocks} == set(range(salts))
    entries, _ = vector_codes._nearest(parts, books[0], np.float64)
    wanted = vector_codes._cells(0, rows, entries, salts)
    seen = 0
    for cell, block in blocks:
        for other, (_, own, named, _, leaves) in vector_codes._reassigned(books, salts, np.float64)(iter([(cell, block)])):
            own, named = np.frombuffer(own, np.int64), np.frombuffer(named, np.uint8)
            assert leaves == (other != cell) and (wanted[own] == other).all() and (entries[own] == named).all()
            seen += len(own)
            if leaves:
                assert (old[own] != named).all()
    assert seen == 300


def test_owners_share_a_partitioning(spark):
    """What stays and what arrives is put together without a shuffle."""
    rdd = spark.sparkContext.parallelize([(k, "x") for k in range(8)]).partitionBy(4, vector_codes._owner)
    staying = rdd.mapPartitions(lambda x: x, preservesPartitioning=True).filter(lambda x: x[0] % 2)
    arriving = rdd.filter(lambda x: not x[0] % 2).map(lambda x: x).partitionBy(4, vector_codes._owner)
    both = staying.union(arriving)
    assert both.getNumPartitions() == 4
    assert all({key % 4 for key, _ in own} <= {k} for k, own in enumerate(both.glom().collect()))

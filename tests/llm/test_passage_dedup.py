from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.texts import awkward, clashing, documents, prose
from tripline.llm import passage_dedup
from tripline.llm.flat import SPACED, flattened, words_of
from tripline.llm.passage_dedup import _revealing, without_repeated_passages


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_force(rows: list, n: int = 20) -> list:
    first: dict[tuple, tuple] = {}
    split = [(float("inf") if doc_id is None else doc_id, doc_id, words(text)) for doc_id, text in rows]
    for order, _, own in split:
        for k in range(len(own) - n + 1):
            window = tuple(own[k : k + n])
            first[window] = min(first.get(window, (order, k)), (order, k))
    out = []
    for order, doc_id, own in split:
        gone = [False] * len(own)
        for k in range(len(own) - n + 1):
            if first[tuple(own[k : k + n])] < (order, k):
                gone[k : k + n] = [True] * n
        out.append((doc_id, len(own), sum(gone), " ".join(w for w, g in zip(own, gone) if not g)))
    return sorted(out, key=repr)


def check(docs) -> None:
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = sorted((tuple(row) for row in without_repeated_passages(docs).collect()), key=repr)
    assert found == brute_force(rows)


def test_awkward_rows(spark):
    check(clashing(documents(spark, awkward())).repartition(5))


def test_awkward_rows_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(passage_dedup, "bucket_count", lambda rows: 7)
    check(documents(spark, awkward()).repartition(30, "text"))


def test_empty_tables(spark):
    assert without_repeated_passages(documents(spark, [])).collect() == []
    check(documents(spark, [None, "", None]))


def test_documents(spark, sf_dir):
    check(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def test_runs_and_periods(spark):
    """Windows that no round of rewriting settles."""
    a, b = "a " * 30, "b " * 30
    texts = [a, b, a + b, b + a, a + "x " + a, "p q r " * 20, "x " + "p q r " * 10, "a " * 10 + "b " * 10, "z " + a + b]
    texts += ["a " * k + "b " * (25 - k) for k in range(26)]
    check(documents(spark, texts))


def test_limits(spark):
    common = prose(31, 60, 4000)
    texts = [" ".join(common)] + [f"q{k} " + " ".join(common[7 : 7 + n]) + f" z{k}" for k, n in enumerate((18, 19, 20, 21, 40))]
    check(documents(spark, texts))


@pytest.mark.parametrize("vocabulary", [2, 3, 50])
def test_equal_windows_are_revealed_by_equal_symbols(vocabulary):
    """Of every two equal windows, all symbols that reveal the one reveal the other."""
    texts = [" ".join(prose(seed, 150, vocabulary)) for seed in range(6)]
    texts += [" ".join(words(texts[0])[20:70] + words(texts[1])[90:140])]
    own = words_of(flattened(pa.array(texts)), SPACED)
    revealed: dict[int, set] = {}
    for names, first, last, new in _revealing(own, 20):
        for name, low, high in zip(names, first, last):
            for k in range(low, high + 1):
                if new[k]:
                    revealed.setdefault(k, set()).add((int(name), k - low if low == high else None))
    split = [tuple(words(t)[k : k + 20]) for t in texts for k in range(len(words(t)))]
    by_window: dict[tuple, list] = {}
    ends = np.repeat(own.offsets[1:], own.counts)
    for k in range(len(own)):
        if k + 20 <= ends[k]:
            assert revealed.get(k)
            by_window.setdefault(split[k], []).append({name for name, _ in revealed[k]})
    assert any(len(found) > 1 for found in by_window.values())
    for found in by_window.values():
        assert all(names == found[0] for names in found)


def test_codes_of_copies_are_told_once():
    """Blocks that each send the names of a copy do not make its row longer."""
    import pyarrow as pa

    from tripline.llm.repeats import _answered, joined_codes

    def told(bucket, hashes, counts, names, kind):
        rows = len(hashes)
        return _answered(pa.table({
            "bucket": pa.array([bucket] * rows, pa.int32()),
            "hashes": [np.array([h], np.int64).tobytes() for h in hashes],
            "counts": [np.array([c], np.int32).tobytes() for c in counts],
            "names": [np.array(n, kind).tobytes() for n in names],
            "seen": [np.ones(c, np.uint8).tobytes() for c in counts],
            "large": [b""] * rows,
        }), 100_000)

    out = told(3, [7] * 50 + [8], [2] * 50 + [1], [[5, 6]] * 50 + [[5]], np.uint32)
    assert out.column("hash").to_pylist() == [7, 8] and [len(x) for x in out.column("names").to_pylist()] == [8, 8]
    out = told(-1, [7] * 50, [0] * 50, [[5, 6]] * 49 + [[6, 9]], np.uint64)
    assert [list(x) for x in joined_codes(pa.array([out.column("names").to_pylist()]))] == [[5, 6, 9]]


def test_crowded_names_are_counted_in_full():
    """A block counts the texts of a name to 254 in a byte, and beyond that in a number of its own."""
    import pyarrow as pa

    from tripline.llm.repeats import _answered

    def many(counts: list[int], crowd: int) -> list:
        out = _answered(pa.table({
            "bucket": pa.array([0] * len(counts), pa.int32()),
            "hashes": [np.array([k], np.int64).tobytes() for k in range(len(counts))],
            "counts": [np.array([2], np.int32).tobytes() for _ in counts],
            "names": [np.array([5, 6], np.uint32).tobytes() for _ in counts],
            "seen": [np.array([min(n, 255), 1], np.uint8).tobytes() for n in counts],
            "large": [np.array([n] if n >= 255 else [], np.int32).tobytes() for n in counts],
        }), crowd)
        return [np.frombuffer(row["names"], np.uint64).tolist() for row in out.to_pylist() if row["hash"] is None]

    assert many([60_000, 254, 40_000], 100_254) == [[5]]
    assert many([60_000, 254, 40_000], 100_255) == []
    assert many([255, 255], 510) == [[5]]

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.texts import SCHEMA, awkward, clashing, documents
from tripline.llm import queries
from tripline.llm.flat import flattened
from tripline.llm.language import _counted, identify, learn
from tripline.llm.sampling import by_label


@pytest.fixture(scope="module")
def found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    query = queries.op3_language(spark, "/root/testdata/sf0.01")
    return query.join(docs.select("doc_id", "lang", "text"), "doc_id").collect()


def test_held_out_accuracy(found):
    held = [row for row in found if row.held_out]
    assert len(found) == 1000 and 200 < len(held) < 300
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 4 == 2) for row in found)
    assert sum(row.lang_pred == row.lang for row in held) / len(held) >= 0.97
    assert all(0 <= row.score <= 1 for row in found)


def test_awkward_rows(spark, sf_dir):
    machines = learn(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    docs = clashing(documents(spark, awkward() + ["123 - 456 !!", "٣٤٥", "ª", "x"], lang=None))
    rows = {(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()}
    out = identify(docs, machines).collect()
    assert len(out) == docs.count()
    languages = {lang for members in machines.members for lang in members}
    for doc_id, text in rows:
        own = [r for r in out if r.doc_id == doc_id]
        if text is None or not any(c.isalpha() for c in text):
            assert any(r.lang_pred == "und" and r.score == 0 and not r.accepted for r in own)
        else:
            assert any(r.lang_pred in languages and r.score > 0 for r in own)


def test_prediction_does_not_depend_on_neighbours(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    machines = learn(docs)
    one = identify(docs.repartition(1), machines).collect()
    many = identify(docs.repartition(13, "text"), machines).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, many))


def test_little_to_learn_from(spark):
    none = learn(documents(spark, []))
    assert [r.lang_pred for r in identify(documents(spark, ["abc"]), none).collect()] == ["und"]
    assert identify(documents(spark, []), none).collect() == []
    one = learn(documents(spark, ["abc", "def"], lang="xx"))
    assert [tuple(r)[1:3] for r in identify(documents(spark, ["abc", None]), one).collect()] == [("xx", 1.0), ("und", 0.0)]


def test_families_of_three(spark):
    """Unknown languages are families of their own; inside a family each pair has its machine."""
    words = {"en": "the and of", "de": "der und von", "nl": "het een van", "fr": "le et du", "zz": "qxz zxq"}
    rows = [(k, " ".join([text] * (3 + k % 7)), lang, None, 0) for lang, text in words.items() for k in range(40)]
    docs = spark.createDataFrame([(n, *row[1:]) for n, row in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    machines = learn(docs)
    assert machines.families == ["germanic", "romance", "zz"]
    assert [sorted(m) for m in machines.members] == [["de", "en", "nl"], ["fr"], ["zz"]]
    assert len(machines.pairs) == 3 + 3
    out = {r.doc_id: r.lang_pred for r in identify(docs, machines).collect()}
    assert all(out[n] == row[2] for n, row in enumerate(rows))


def test_histogram_counts_runs_inside_texts():
    shares = _counted(flattened(pa.array(["ab", "", "b", "abc"])), 8192)
    assert np.allclose(shares.sum(axis=1), [1, 0, 1, 1]) and shares.shape[1] == 8192
    assert (shares[0] > 0).sum() == 3 and (shares[3] > 0).sum() == 6


def test_sample_is_bounded(spark):
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), (F.col("id") % 3 == 0).cast("string").alias("lang"))
    counts = {r.lang: r["count"] for r in by_label(rows, "lang", 500).groupBy("lang").count().collect()}
    assert all(400 < n < 600 for n in counts.values()) and len(counts) == 2


def test_sample_is_bounded_for_a_shared_id(spark):
    """Rows of one doc_id, or of none, are drawn apart; rows that are alike count once."""
    for k in range(8):  # some of these ids would be drawn, some not
        one = F.lit(None).cast("long") if k == 0 else F.lit(k)
        rows = spark.range(4000).select(one.alias("doc_id"), F.col("id").cast("string").alias("text"), F.lit("x").alias("lang"))
        n = by_label(rows, "lang", 1000).count()
        assert 800 < n < 1200
    same = spark.range(4000).select(F.lit(1).alias("doc_id"), F.lit("t").alias("text"), F.lit("x").alias("lang"))
    assert by_label(same, "lang", 1000).count() == 1


def close_pair(seed: int, n: int) -> list:
    """Two made languages of one family, alike but for a fifth of their words, which differ in a letter or two."""
    draw = random.Random(seed)
    stems = ["".join(draw.choice("bdfgklmnprstv") + draw.choice("aeiouy") for _ in range(3)) for _ in range(300)]
    other = [stem[:-1] + {"a": "e", "e": "æ", "i": "j", "o": "ø", "u": "å", "y": "ij"}[stem[-1]] if k % 5 == 0 else stem for k, stem in enumerate(stems)]
    return [(" ".join(draw.choice(words) for _ in range(draw.randrange(25, 60))), lang) for lang, words in (("da", stems), ("no", other)) for _ in range(n)]


def test_a_close_pair(spark):
    rows = close_pair(5, 300)
    docs = spark.createDataFrame([(k, text, lang, None, 0) for k, (text, lang) in enumerate(rows)], SCHEMA)
    taught = F.col("doc_id") % 3 != 0
    accuracy = {}
    for bins in (64, 8192):
        machines = learn(docs.where(taught), bins=bins)
        assert machines.weights.shape == (bins, 1) and machines.families == ["germanic"]
        found = {r.doc_id: r.lang_pred for r in identify(docs.where(~taught), machines).collect()}
        accuracy[bins] = sum(lang == rows[k][1] for k, lang in found.items()) / len(found)
    assert accuracy[8192] >= 0.95 and accuracy[8192] >= accuracy[64]
    with pytest.raises(ValueError, match="power of two"):
        learn(docs, bins=1000)


def plain_decision(text: str, machines) -> tuple[str, float]:
    """The decision in loops: counts of runs in a dictionary, one margin a machine, votes inside the winning family."""
    data = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in text.lower().encode())
    counts = Counter()
    for size in (1, 2, 3):
        for k in range(len(data) - size + 1):
            x = (int.from_bytes(data[k : k + size], "big") + (size << 32)) % 2**64
            x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) % 2**64
            x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) % 2**64
            counts[(x ^ (x >> 31)) >> (65 - machines.bins.bit_length())] += 1
    total = sum(counts.values())

    def winner(where: int, names: list) -> tuple[int, float]:
        votes, least = [0.0] * len(names), [math.inf] * len(names)
        for k, (place, a, b) in enumerate(machines.pairs):
            if place == where:
                margin = sum(n / total * machines.weights[bin_, k] for bin_, n in counts.items()) + machines.bias[k]
                votes[a if margin > 0 else b] += 1
                votes[a] += 1e-3 * math.tanh(margin)
                votes[b] -= 1e-3 * math.tanh(margin)
                least[a], least[b] = min(least[a], margin), min(least[b], -margin)
        best = max(range(len(names)), key=votes.__getitem__)
        return best, 1 / (1 + math.exp(-3 * min(max(least[best], 0), 50)))

    family, clear = winner(-1, machines.families)
    language, sure = winner(family, machines.members[family])
    return machines.members[family][language], clear * sure


def test_plain_votes_of_the_same_machines(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    machines = learn(docs)
    found = identify(docs, machines).join(docs.select("doc_id", "text"), "doc_id").where("lang_pred <> 'und'").collect()
    assert len(found) > 150
    for row in found:
        lang, score = plain_decision(row.text, machines)
        assert row.lang_pred == lang and row.score == pytest.approx(score, abs=1e-4)

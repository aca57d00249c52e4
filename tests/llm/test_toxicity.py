from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from tests.llm.texts import awkward, clashing, documents, prose
from tripline.llm import queries
from tripline.llm.toxicity import learn, toxicity


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = queries.op4_toxicity(spark, sf_dir)
    rows = found.join(labels, "doc_id").where("held_out").collect()
    assert found.count() == 10_000
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    toxic = [r for r in rows if r.toxic == 1]
    right = sum(r.predicted for r in toxic)
    assert right / len(toxic) > 0.6 and right / max(1, sum(r.predicted for r in rows)) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


@pytest.fixture(scope="module")
def pairs(spark):
    """Texts that are toxic only if they have an insult and a group: each alone is not."""
    draw, texts, toxic = random.Random(4), [], []
    for k in range(1500):
        insult, group = draw.random() < 0.5, draw.random() < 0.5
        words = prose(1000 + k, 40, 200) + ["scoundrels"] * insult + ["neighbours"] * group
        draw.shuffle(words)
        texts.append(" ".join(words))
        toxic.append(int(insult and group))
    return documents(spark, texts), spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int"), toxic


def test_pairs_of_terms(pairs):
    docs, labels, toxic = pairs
    found = {r.doc_id: r for r in toxicity(docs, learn(docs, labels)).collect()}
    held = [k for k in range(len(toxic)) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert sum(found[k].predicted == toxic[k] for k in held) / len(held) > 0.97


def test_partners_that_do_not_tell_alone(spark):
    """A mention of a group is as common in clean texts as in toxic ones; beside an insult it makes them toxic."""
    draw, texts, toxic, groups = random.Random(5), [], [], []
    for k in range(6000):
        words = [f"w{draw.randrange(5000)}" for _ in range(draw.randrange(20, 80))]
        bad, kind = draw.random() < 0.2, draw.random()
        group = kind < 0.5
        insult = group if bad else 0.5 <= kind < 0.7
        words += [f"insult{draw.randrange(10)}"] * insult + [f"group{draw.randrange(20)}"] * group
        words += [f"threat{draw.randrange(10)}"] * (bad and not group)
        draw.shuffle(words)
        texts.append(" ".join(words))
        toxic.append(int(bad))
        groups.append(group)
    shares = [np.mean([g for g, t in zip(groups, toxic) if t == value]) for value in (0, 1)]
    assert abs(shares[0] - shares[1]) < 0.03
    docs = documents(spark, texts)
    labels = spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")
    found = {r.doc_id: r.predicted for r in toxicity(docs, learn(docs, labels)).collect()}
    held = [k for k in range(len(toxic)) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert sum(found[k] == toxic[k] for k in held) / len(held) > 0.97


def test_awkward_rows(spark, pairs):
    docs, labels, _ = pairs
    machine = learn(docs, labels)
    out = toxicity(clashing(documents(spark, awkward())), machine).collect()
    assert len(out) == len(awkward())
    empty = 1 / (1 + np.exp(-machine.bias))
    assert all(r.score == pytest.approx(empty) for r in out if r.doc_id in (0, 1, 2))
    one, many = (sorted(toxicity(docs.repartition(n), machine).collect()) for n in (1, 9))
    assert [r.doc_id for r in one] == [r.doc_id for r in many]
    assert [r.score for r in one] == pytest.approx([r.score for r in many])


def test_little_to_learn_from(spark):
    docs = documents(spark, ["a b", "c", None])
    for labels in ([], [(1, 0)], [(1, 1), (1, 0), (2, None), (None, 1)]):
        machine = learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        scores = [r.score for r in toxicity(docs, machine).collect()]
        assert len(set(scores)) == 1 and 0 <= scores[0] <= 1
    assert toxicity(documents(spark, []), machine).collect() == []


def test_sample_is_bounded_for_a_shared_id(spark, monkeypatch):
    """A labelled doc_id that many rows share does not bring all of them."""
    import tripline.llm.toxicity as module

    sizes = []
    monkeypatch.setattr(module, "_fitted", lambda lists, y, *_: sizes.append(len(y)))
    for one in range(1, 7):
        docs = documents(spark, [(one, f"a{k}") for k in range(3000)] + [(100 + k, f"b{k}") for k in range(100)])
        learn(docs, spark.createDataFrame([(one, 0)] + [(100 + k, k % 2) for k in range(100)], "doc_id long, toxic int"), toxic=50, clean=300)
    assert all(n < 450 for n in sizes) and max(sizes) > 250

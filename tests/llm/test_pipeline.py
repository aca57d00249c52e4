from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from tests.llm import test_decontamination, test_language, test_mixing, test_near_duplicates
from tests.llm.texts import awkward, clashing, documents
from tripline.llm import language
from tripline.llm.sampling import remainder


def plain(docs) -> list:
    return [(r.doc_id, r.text, r.source) for r in docs.select("doc_id", "text", "source").collect()]


def check(spark, docs, sf_dir) -> list:
    """Every stage against its brute-force version, on what the stage before kept."""
    columns = docs.columns
    stages = dict(pipeline.STAGES)
    assert list(stages) == ["language_id", "near_dedup", "decontaminate", "mix_sources", "tokenize"]

    before = plain(docs)
    machines = language.learn(docs.where(remainder(F.col("doc_id"), 4) != 2))
    docs = stages["language_id"](spark, docs, sf_dir).cache()
    assert docs.columns == columns

    def in_a_language(text) -> bool:
        letters = any(c.isalpha() for c in text or "")
        return letters and (not machines.families or test_language.plain_decision(text, machines)[1] >= pipeline.MIN_SCORE)

    named = {i for i, text, _ in before if i is not None and in_a_language(text)}
    assert Counter(plain(docs)) == Counter(row for row in before if row[0] in named)

    before = plain(docs)
    docs = stages["near_dedup"](spark, docs, sf_dir).cache()
    assert docs.columns == columns
    component = test_near_duplicates.brute_force([row[:2] for row in before])
    assert Counter(plain(docs)) == Counter(row for row in before if component[row[0]] == row[0])

    before = plain(docs)
    docs = stages["decontaminate"](spark, docs, sf_dir).cache()
    assert docs.columns == columns
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    hit = {row[0] for row in test_decontamination.brute_force([row[:2] for row in before], items) if row[2]}
    assert Counter(plain(docs)) == Counter(row for row in before if row[0] not in hit)

    before = plain(docs)
    docs = stages["mix_sources"](spark, docs, sf_dir).cache()
    assert docs.columns == columns
    wanted = Counter()
    for doc_id, _, size, _, _, taken in test_mixing.brute_force(before):
        if size:
            wanted[doc_id] += taken // size
    texts = {row[0]: row for row in before}
    found = Counter(row[0] for row in plain(docs))
    assert found == +wanted
    assert set(plain(docs)) <= set(before) and len(texts) <= len(before)

    before = plain(docs)
    out = stages["tokenize"](spark, docs, sf_dir).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = [(i, [*tokenizer.encode(text, add_special_tokens=False).ids, 2]) for i, text, _ in before]
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in out) == Counter(
        (i, len(own), zlib.crc32(np.array(own, "<u4").tobytes())) for i, own in ids
    )
    at = 0
    for row in sorted(out, key=lambda r: r.start):
        assert row.start == at
        at += row.n_tokens
    return sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in out)


@pytest.fixture(scope="module")
def by_stages(spark):
    sf_dir = "/root/testdata/sf0.001"
    return check(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir)


def test_run(spark, sf_dir, by_stages):
    assert sorted(map(tuple, pipeline.run(spark, sf_dir).select("doc_id", "start", "n_tokens", "ids_crc32").collect())) == by_stages


def test_awkward_rows(spark, sf_dir):
    """Rows that share a doc_id stay or go together, so ids are made unique but for equal rows."""
    texts = [text if not isinstance(text, tuple) else (text[0] if text[0] != 7 else 77, text[1]) for text in awkward()]
    unique = [text for text in texts if not (isinstance(text, tuple) and text[0] == 3)]
    check(spark, clashing(documents(spark, unique + [(900, "twice the same"), (900, "twice the same")])), sf_dir)


def test_empty_table(spark, sf_dir):
    docs = documents(spark, [])
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.collect() == []
        docs = documents(spark, [])


def test_table_without_languages(spark, sf_dir):
    """Nothing can be learned; texts with a letter stay all the same."""
    docs = documents(spark, ["some words", "12 - 34", "", None, "слово", (None, "no id")], lang=None)
    stage = dict(pipeline.STAGES)["language_id"]
    assert sorted(r.doc_id for r in stage(spark, docs, sf_dir).collect()) == [0, 4]


def test_rows_without_doc_id_go_alike_in_each_stage(spark, sf_dir):
    """What no later stage could name goes, also from a stage that is run by itself; rows of one doc_id stay together."""
    window = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first().text
    rows = [(1, "one two three four five six"), (None, "seven eight nine ten eleven twelve"), (None, window), (2, window), (None, None)]
    docs = documents(spark, rows)
    stages = dict(pipeline.STAGES)
    assert {r.doc_id for r in stages["language_id"](spark, docs, sf_dir).collect()} == {1, 2}
    assert {r.doc_id for r in stages["near_dedup"](spark, docs, sf_dir).collect()} == {1, 2}
    assert {r.doc_id for r in stages["decontaminate"](spark, docs, sf_dir).collect()} == {1}


def test_texts_that_mix_languages_go(spark, sf_dir):
    """The score decides: of texts cut together from four languages some go, and whole ones stay."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("n_chars BETWEEN 300 AND 3000")
    by = {lang: [r.text for r in docs.where(F.col("lang") == lang).sort("doc_id").limit(60).collect()] for lang in ("en", "de", "fr", "es")}
    mixed_up = [" ".join(w for texts in by.values() for w in texts[k].split()[: 12 + k % 5]) for k in range(60)]
    extra = documents(spark, mixed_up, first=10**6, lang=None).select("doc_id", "text", "lang", "source", "n_chars")
    both = docs.select("doc_id", "text", "lang", "source", "n_chars").union(extra)
    kept = {r.doc_id for r in pipeline.language_id(spark, both, sf_dir).collect()}
    assert len([k for k in range(60) if 10**6 + k not in kept]) >= 1
    assert len([i for i in kept if i < 10**6]) >= 0.995 * docs.count()

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.texts import awkward, clashing, documents
from tripline.llm import byte_bpe
from tripline.llm.byte_bpe import Pieces, Texts, decoded, digest, encoded, read_ranks

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WANTED = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={})
TEXTS = Texts(RANKS, public_tokenizers.PATTERN)


def wanted(texts: list) -> list:
    out = []
    for doc_id, text in texts:
        ids = WANTED.encode_ordinary(text or "")
        sha = [hashlib.sha256(x).hexdigest() for x in (" ".join(map(str, ids)).encode(), (text or "").encode())]
        out.append((doc_id, len(ids), *sha))
    return sorted(out, key=repr)


def collected(docs) -> list:
    tokens = encoded(docs, RANKS, public_tokenizers.PATTERN)
    return sorted((tuple(row) for row in digest(decoded(tokens, RANKS)).collect()), key=repr)


def check(docs) -> None:
    assert collected(docs) == wanted([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_awkward_rows(spark):
    check(clashing(documents(spark, [*awkward(), "x" * 70_000, " " * 70_000 + "a", "ab" * 40_000 + " c" * 40_000])))


def test_empty_tables(spark):
    check(documents(spark, []))
    check(documents(spark, [None, ""]))


def test_documents(spark, sf_dir):
    check(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def test_ids_stand_for_the_text(spark):
    docs = documents(spark, ["One, two  three's", None])
    rows = decoded(encoded(docs, RANKS, public_tokenizers.PATTERN), RANKS).collect()
    assert [bytes(row.decoded).decode() for row in rows] == ["One, two  three's", ""]
    assert rows[0].ids == WANTED.encode_ordinary("One, two  three's") and rows[1].ids == []


def test_bytes_that_are_no_text(spark):
    broken = documents(spark, ["a"]).withColumn("text", F.unhex(F.lit("61FF62")).cast("string"))
    assert collected(broken)[0][1:3] == wanted([(0, "a�b")])[0][1:3]


def test_unknown_id_is_an_error(spark):
    tokens = spark.createDataFrame([(1, [70_000])], "doc_id long, ids array<int>")
    with pytest.raises(Exception, match="70000"):
        decoded(tokens, RANKS).collect()
    assert decoded(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), RANKS).first().decoded == b""


# What matching can stumble over at a cut: contractions, runs, blanks before words, letters of newer Unicode.
STUMBLES = ["a", "re", "ll", "'", "'s", " ", "  ", "\n", "　", "1", "é", "漢", "!", "x" * 50, "ab" * 90, " " * 140, "!" * 150, "9" * 140, "\U0003fc3f", "́", "ß'"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(STUMBLES), max_size=40), st.sampled_from([2, 3, 16, 200]))
def test_tree_over_texts(parts, leaf):
    kept = byte_bpe.LEAF
    byte_bpe.LEAF = leaf
    try:
        text = "".join(parts)
        assert TEXTS.ids(text).tolist() == WANTED.encode_ordinary(text)
    finally:
        byte_bpe.LEAF = kept


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abx ", max_size=200), st.integers(0, 200))
def test_join_of_any_two_parts(text, cut):
    pieces = TEXTS.pieces
    data = text.encode()
    if 0 < cut < len(data):
        assert pieces.join(pieces.merged(data[:cut]), pieces.merged(data[cut:])) == pieces.merged(data) == pieces._merged_long(data)


def test_neighbours_that_stay_make_the_encoding():
    """What a join relies on: tokens are those of the bytes if and only if each two neighbours stay as they are."""
    draw, pieces = random.Random(4), Pieces(read_ranks(RANKS))
    for _ in range(3000):
        data = "".join(draw.choice(["a", "b", "an", "the", "in", "é"]) for _ in range(draw.randrange(2, 9))).encode()
        cuts = sorted(draw.sample(range(1, len(data)), min(3, len(data) - 1)))
        parts = [data[a:b] for a, b in zip([0, *cuts], [*cuts, len(data)])]
        if all(part in pieces.ranks and pieces.merged(part) == (pieces.ranks[part],) for part in parts):
            tokens = tuple(pieces.ranks[part] for part in parts)
            stays = all(pieces.merged(x + y) == (pieces.ranks[x], pieces.ranks[y]) for x, y in zip(parts, parts[1:]))
            assert stays == (pieces.merged(data) == tokens)

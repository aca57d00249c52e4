from __future__ import annotations

import json
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.texts import awkward, clashing, documents
from tripline.llm import token_files
from tripline.llm.store import new_path
from tripline.llm.token_files import digest, read_tokens, write_tokens

ODD = [
    "It's don't 'quoted' o'clock's",
    "a<|endoftext|>b <|STARTOFTEXT|> c<|startoftext|>",
    "v2.0 3,14 ½ x²",
    "Café Café é̂ -́- İstanbul ΣΑΣ ſ",
    "tab\tnew\nline\x0b\x0c\r\x1c\x85  end",
    "emoji 👩‍👩‍👧 🇫🇷 a👍b",
    "日本語 テスト ไทย हिन्दी العربية",
    "%%%word&&& a--b 'S 'LL",
]


def check(spark, docs, name="word_bpe_49k.json", end=2) -> None:
    path = new_path(spark, "tokens")
    write_tokens(docs, path, public_tokenizers.path(name), end)
    found = digest(read_tokens(spark, path)).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    rows = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    wanted = {}
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, end]
        wanted.setdefault(doc_id, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert len(found) == len(rows)
    got = {}
    at = 0
    for row in sorted(found, key=lambda r: (r.start)):
        assert row.start == at
        at += row.n_tokens
        got.setdefault(row.doc_id, []).append((row.n_tokens, row.ids_crc32))
    in_order = [row.doc_id for row in sorted(found, key=lambda r: r.start)]
    assert in_order == sorted(in_order, key=lambda x: (x is None, x or 0))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in wanted.items()}


def test_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_BYTES", 40_000)
    check(spark, clashing(documents(spark, awkward() + ODD)).repartition(3))


def test_empty_tables(spark):
    check(spark, documents(spark, []))
    check(spark, documents(spark, [None, "", None]))


def test_documents(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_BYTES", 100_000)
    check(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))


def test_a_tokenizer_that_keeps_blanks(spark):
    check(spark, documents(spark, awkward() + ODD), "byte_bpe_50k.json", 50256)


def changed(change) -> Tokenizer:
    steps = json.loads(Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).to_str())
    change(steps)
    return Tokenizer.from_str(json.dumps(steps))


@pytest.mark.parametrize(
    "change",
    [
        lambda steps: steps["normalizer"]["normalizers"].pop(),
        lambda steps: steps["normalizer"]["normalizers"].__setitem__(0, {"type": "NFKC"}),
        lambda steps: steps["normalizer"].update(normalizers=[{"type": "Prepend", "prepend": "x"}, *steps["normalizer"]["normalizers"]]),
        lambda steps: steps["pre_tokenizer"]["pretokenizers"][0].update(behavior="Isolated"),
        lambda steps: steps["pre_tokenizer"]["pretokenizers"][0]["pattern"].update(Regex=r"\S+ \S+|\S+"),
        lambda steps: steps["pre_tokenizer"]["pretokenizers"][1].update(add_prefix_space=True),
        lambda steps: steps["added_tokens"].append({"id": 49408, "content": "one, two", "single_word": False, "lstrip": False, "rstrip": False, "normalized": True, "special": False}),
    ],
)
def test_other_tokenizers_get_whole_texts(change):
    """What the file says decides, not how the tokenizer does on some texts."""
    import pyarrow as pa

    known = token_files._Remembered(changed(lambda steps: None))
    assert known.by_word
    tokenizer = changed(change)
    known = token_files._Remembered(tokenizer)
    assert not known.by_word
    texts = [*ODD, "One, two, three  Four", "A B c d's ﬁ x", "one two", "x"]
    ids, counts = known.encoded(token_files.flattened(pa.array(texts)), 2)
    cut = np.cumsum(counts)
    for text, a, b in zip(texts, np.append(0, cut), cut):
        assert ids[a:b].tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 2]


def test_forgetting(spark, monkeypatch):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    monkeypatch.setattr(token_files, "REMEMBERED", 10)
    known = token_files._Remembered(tokenizer)
    import pyarrow as pa

    for text in [*ODD, "the quick brown fox", "the slow " * 20]:
        ids, _ = known.encoded(token_files.flattened(pa.array([text])), 2)
        assert ids.tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 2]


def test_files_prune_by_doc_id(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_BYTES", 100_000)
    path = new_path(spark, "tokens")
    write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, public_tokenizers.path("word_bpe_49k.json"))
    one = spark.read.orc(path).where("doc_id = 17")
    assert one.count() == 1
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,17)]" in one._jdf.queryExecution().executedPlan().toString()

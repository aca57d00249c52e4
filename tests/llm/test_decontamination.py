from __future__ import annotations

import re

from pyspark.sql import functions as F

from tests.llm.texts import awkward, clashing, documents, prose
from tripline.llm import decontamination
from tripline.llm.decontamination import contamination


def words(text: str | None) -> list[str]:
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute_force(rows: list, items: list) -> list:
    windows = [(item, own[k : k + 10]) for item, text in items if (own := words(text)) for k in range(max(1, len(own) - 9))]
    out = []
    for doc_id, text in rows:
        own = words(text)
        hit, found = set(), set()
        for item, window in windows:
            for k in range(len(own) - len(window) + 1):
                if own[k : k + len(window)] == window:
                    hit.update(range(k, k + len(window)))
                    found.add(item)
        listed = sorted({str(item) for item in found if item is not None})
        out.append((doc_id, len(own), len(hit), len(listed), listed))
    return sorted(out, key=repr)


def check(docs, items) -> None:
    found = contamination(docs, items)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    wanted = brute_force(rows, [(r.item_id, r.text) for r in items.select("item_id", "text").collect()])
    assert sorted((tuple(r)[:5] for r in found.collect()), key=repr) == wanted
    for row in found.collect():
        assert sum(b - a + 1 for a, b in zip(row.firsts, row.lasts)) == row.n_hit


def _items(spark, texts):
    rows = [text if isinstance(text, tuple) else (k, text) for k, text in enumerate(texts)]
    return spark.createDataFrame(rows, "item_id long, text string")


SOME = [
    " ".join(prose(1, 120)[30:60]),
    " ".join(prose(1, 120)[50:62]).upper().replace(" ", " - "),
    " ".join(prose(2, 90, 40)[5:15]),
    " ".join(prose(2, 90, 40)[5:14]),
    "one",
    "One, two!",
    "the the the the the the the the the the the",
    "漢字",
    "ñandú Ü ß",
    "not anywhere at all",
    None,
    "",
    "- - -",
    (None, "three four"),
    (4, "five"),
    (77, "one"),
]


def test_awkward_rows(spark):
    check(clashing(documents(spark, awkward())), _items(spark, SOME).withColumn("hits", F.lit(1)))


def test_items_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 40)
    check(documents(spark, awkward()), _items(spark, SOME))


def test_empty_tables(spark):
    check(documents(spark, awkward()), _items(spark, []))
    check(documents(spark, awkward()), _items(spark, [None, " "]))
    check(documents(spark, []), _items(spark, SOME))


def test_documents(spark, sf_dir):
    check(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))

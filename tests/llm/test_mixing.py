from __future__ import annotations

import hashlib
import re
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tests.llm.texts import awkward, clashing, documents, prose
from tripline.llm.mixing import mixed, mixture


def brute_force(rows: list, weights=(1, 2, 3), epochs=3) -> list:
    """Water-filling as it is told: share, clamp, share what was left again."""
    def draw(doc_id, text) -> str:
        parts = ["mix", *([str(doc_id)] if doc_id is not None else [])]
        parts += [hashlib.md5(text.encode()).hexdigest()] if text is not None else []
        return hashlib.md5(":".join(parts).encode()).hexdigest()

    rows = [
        (doc_id, source, len(re.findall(r"[^\x20\x09-\x0D]+", text or "")), draw(doc_id, text)) for doc_id, text, source in rows
    ]
    sizes = Counter()
    for _, source, size, _ in rows:
        sizes[source] += size
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {name: weights[k % len(weights)] for k, name in enumerate(names)}
    target = dict.fromkeys(names, Fraction(0))
    open_, left = set(names), Fraction(sum(sizes.values()))
    while open_:
        total = sum(weight[n] for n in open_)
        share = {n: left * weight[n] / total for n in open_}
        above = {n for n in open_ if share[n] >= epochs * sizes[n]}
        if not above:
            target |= share
            break
        for n in above:
            target[n] = Fraction(epochs * sizes[n])
            left -= target[n]
        open_ -= above
    out = []
    for name in names:
        own = sorted(
            (key, i is None, i or 0, size, i) for i, s, size, key in rows if s == name
        )
        whole = int(target[name] // sizes[name]) if sizes[name] else epochs
        rest, before = target[name] - whole * sizes[name], 0
        for _, _, _, size, doc_id in own:
            times = whole + (2 * before + size <= 2 * rest and whole < epochs)
            out.append((doc_id, name, size, sizes[name], float(target[name]), size * times))
            before += size
    return sorted(out, key=repr)


def check(docs) -> None:
    rows = [(r.doc_id, r.text, r.source) for r in docs.select("doc_id", "text", "source").collect()]
    found = mixture(docs).select("doc_id", "source", "size", "source_size", "target", "taken").collect()
    found = sorted((tuple(r) for r in found), key=repr)
    wanted = brute_force(rows)
    assert [r[:4] + r[5:] for r in found] == [r[:4] + r[5:] for r in wanted]
    assert [r[4] for r in found] == pytest.approx([r[4] for r in wanted])


def test_awkward_rows(spark):
    docs = documents(spark, awkward())
    names = F.array(*(F.lit(x) for x in ("b", "a", "Z", "é", "", None, "src10", "src9")))
    check(clashing(docs.withColumn("source", F.element_at(names, (F.pmod(F.xxhash64("text", "doc_id"), F.lit(8)) + 1).cast("int")))))
    check(docs.withColumn("source", F.lit(None).cast("string")))


def test_empty_tables(spark):
    check(documents(spark, []))
    check(documents(spark, [None, "", " "]))


def test_sources_that_are_too_small(spark):
    docs = documents(spark, [" ".join(prose(k, 30 + k)) for k in range(200)])
    docs = docs.withColumn("source", F.expr("CASE WHEN doc_id < 150 THEN 'a' WHEN doc_id < 153 THEN 'b' WHEN doc_id < 160 THEN 'c' ELSE 'd' END"))
    check(docs)
    by = {r.source: r for r in mixture(docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.first("source_size").alias("own")).collect()}
    assert by["b"].taken == by["b"].target == 3 * by["b"].own
    assert all(abs(r.taken - r.target) <= 250 for r in by.values())


def test_documents(spark, sf_dir):
    check(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def test_repeated_documents(spark, sf_dir):
    docs = clashing(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    out = mixed(docs)
    assert out.columns == docs.columns
    times = {r.doc_id: r.times for r in mixture(docs).collect() if r.times}
    assert Counter(r.doc_id for r in out.collect()) == times
    assert out.join(docs.select("doc_id", F.col("text").alias("same")), "doc_id").where("text <> same").count() == 0


def test_rows_without_doc_id_are_spread(spark):
    """Documents that share a doc_id, or have none, lie in bins of their own, not in one that a task would have to order."""
    docs = documents(spark, [(None, " ".join(prose(k, 20))) for k in range(400)])
    check(docs)
    from tripline.llm import mixing

    drawn = docs.select(F.substring(F.md5(F.concat_ws(":", F.lit("mix"), F.col("doc_id").cast("string"), F.md5("text"))), 1, mixing._DIGITS).alias("bin"))
    assert drawn.distinct().count() > 350


def test_only_native_operators(spark, sf_dir):
    plan = mixture(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|MapPartitions|SerializeFromObject", plan)

"""Small tables of documents with every awkward case."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark: SparkSession, texts, first: int = 0, lang: str | None = "en", source: str | None = "s") -> DataFrame:
    """Documents numbered from ``first``; a text may be a pair (doc_id, text)."""
    rows = []
    for k, text in enumerate(texts):
        doc_id, text = text if isinstance(text, tuple) else (first + k, text)
        rows.append((doc_id, text, lang, source, len(text or "")))
    return spark.createDataFrame(rows, SCHEMA)


def clashing(docs: DataFrame) -> DataFrame:
    """The same documents with more columns, named like those operators make."""
    from pyspark.sql import functions as F

    names = ["key", "rep", "a", "b", "bucket", "start", "score", "kept", "n_words", "component_id", "row_key", "size"]
    return docs.withColumns({name: F.lit("x") for name in names})


def prose(seed: int, n: int, vocabulary: int = 300) -> list[str]:
    """Words drawn at random."""
    draw = random.Random(seed)
    return ["w" + format(draw.randrange(vocabulary), "x") for _ in range(n)]


def awkward() -> list:
    """Nulls, empty and very long texts, ties and repeated rows, words in many scripts, runs and periods."""
    base, other = prose(1, 120), prose(2, 90, 40)
    near = base[:60] + ["changed"] + base[61:]
    far = base[:70] + prose(3, 70)
    return [
        None,
        "",
        " \t\r\n ",
        "one",
        "One two",
        "one  TWO",
        "one two three four five",
        " ".join(base),
        " ".join(base).upper(),
        " ".join(near),
        " ".join(far),
        "\n".join(base),
        " ".join(base),
        " ".join(other),
        " ".join(other + base),
        "the " * 300,
        "the " * 299 + "end",
        "ab cd " * 200,
        "x" * 5000,
        "é" * 2000 + " ñandú Ü ß 漢字 русский " * 9,
        "漢字" * 400,
        " ".join(prose(5, 40_000, 900)),
        " ".join(prose(5, 40_000, 900)[200:700]),
        " ".join(prose(6, 30)) + "\x00 nul \x1f unit",
        (3, "one"),
        (3, "one"),
        (7, " ".join(far)),
        (None, " ".join(base)),
        (None, None),
        (-5, " ".join(near)),
    ]

"""The corpus pipeline: documents in, token files out. Each stage works on what the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripline.llm import decontamination, language, mixing, token_files
from tripline.llm.near_duplicates import near_duplicates
from tripline.llm.sampling import remainder
from tripline.llm.store import new_path, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


# The least clear decision that is taken for a language: 0.25 is the border of both its family and itself.
MIN_SCORE = 0.35


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned.

    A document goes if it has no letter (or no text), and if its language cannot be told: if the score of the predicted
    language, which is how clearly its family won times how clearly it won inside it, is under ``MIN_SCORE``, as in texts
    that mix languages or are in none of them. Learned from the rows of ``docs`` that ``op3`` learns from; if nothing
    could be learned, as in a table without ``lang``, texts with a letter stay.
    Rows are judged by doc_id: rows of one doc_id stay if one of them does, rows without doc_id go, for no later stage
    could name them. Very long texts are scored whole; equal scores and repeated rows are treated alike; an empty table
    gives no rows; other columns stay as they are.
    """
    machines = language.learn(docs.where(remainder(F.col("doc_id"), 4) != 2))
    if machines.families:
        kept = language.identify(docs, machines, MIN_SCORE).where("accepted")
    else:
        kept = docs.where(r"text RLIKE '\\p{L}'")
    return _with_ids(docs, kept)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest doc_id.

    Documents without a word are no duplicates of each other and stay. Rows of one doc_id stay if one of them does, rows
    without doc_id go, as in ``language_id``. Very long texts are compared whole; an empty table gives no rows; other
    columns stay as they are.
    """
    return _with_ids(docs, near_duplicates(docs).where("kept"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window.

    Rows of one doc_id go if one of them has a window, rows without doc_id go, as in ``language_id``. NULL and empty
    texts, on either side, have no window. Very long texts are searched whole; an empty table of documents gives no rows,
    an empty benchmark keeps all with a doc_id; other columns stay as they are.
    """
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    hit = decontamination.contamination(docs, items).where("n_hit > 0").select("doc_id").distinct()
    return docs.where("doc_id IS NOT NULL").join(hit, "doc_id", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of sources takes them, each time as a row of its own.

    NULL is a source like others, the last. Rows without doc_id are mixed too, though none comes from the stages before.
    Documents without a word come the whole number of times. Very long texts count whole; rows of equal doc_id are rows
    of their own; an empty table gives no rows; other columns stay as they are.
    """
    return mixing.mixed(docs).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the token files hold: document, place, number of ids and their checksum.

    NULL and empty texts have the end id alone. Repeated rows are encoded each time; rows without doc_id come last. Very
    long texts are encoded whole; an empty table gives no rows; other columns are not written.
    """
    import public_tokenizers

    path = new_path(spark, "tokens")
    token_files.write_tokens(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    return token_files.digest(token_files.read_tokens(spark, path))


def _with_ids(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows whose doc_id is among those kept; NULL is among none."""
    return docs.join(kept.select("doc_id").distinct(), "doc_id", "left_semi").select(*docs.columns)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("tokenize", tokenize),
]

# Language machines are learned; no SQL gives their rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs

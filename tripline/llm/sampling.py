"""Bounded samples of labelled rows, to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the doc_id as text, modulo the divisor; of NULL, that of the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def with_draw(rows: DataFrame) -> DataFrame:
    """The rows with their ``draw``: a hash of doc_id and text, so that rows that share one of them are drawn apart."""
    return rows.withColumn("draw", F.xxhash64(F.lit("sample"), "doc_id", "text"))


def by_label(rows: DataFrame, label: str, each: int | dict) -> DataFrame:
    """About ``each`` rows of every label (all, if there are fewer), chosen by the hash of doc_id and text.

    ``each`` is one number, or one for each label. Rows alike in both are one row. The counts by label, estimated, are
    the only thing gathered beforehand. ``rows`` has columns ``doc_id`` and ``text``; with a column ``draw`` it has
    been through ``with_draw``.
    """
    columns = [name for name in rows.columns if name != "draw"]
    rows = rows if "draw" in rows.columns else with_draw(rows)
    counts = {row[0]: row[1] for row in rows.groupBy(label).agg(F.approx_count_distinct("draw", 0.02)).collect()}
    place = F.pmod(F.col("draw"), F.lit(1 << 30))
    chosen = F.lit(False)
    for value, count in counts.items():
        wanted = each[value] if isinstance(each, dict) else each
        below = int((1 << 30) * min(1.0, wanted / max(1, count)))
        chosen = chosen | (F.col(label).eqNullSafe(F.lit(value)) & (place < F.lit(below)))
    return rows.where(chosen).dropDuplicates([label, "draw"]).select(*columns)

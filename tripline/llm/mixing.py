"""Mixing sources to target weights by capped water-filling, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripline.llm.store import stored

# Bins of the seeded order that are summed before any order is looked at. A document's bin is the first three digits
# of its hash, so the documents of one bin of one source are a 4096th of the source.
_DIGITS = 3
_NUMBER = "decimal(38,0)"


def mixture(
    docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), epochs: int = 3, seed: str = "mix", keep: bool = False
) -> DataFrame:
    """One row per document: ``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``times``, ``taken``.

    ``size`` is the number of words (what stands between blanks; 0 for NULL). Sources in the order of their code
    points, NULL last, weigh ``weights``, repeating, and share all words by weight. A source whose share is more than
    ``epochs`` times its words stops there; what it leaves goes to the others by weight, until none is above.

    A source takes each document the whole number of times that its target holds its words, and once more the
    documents first in a seeded order until the rest is reached, to half a document. The order is the hash of seed,
    doc_id and text, so reruns agree and rows that share a doc_id, or have none, are spread over the order; rows alike in
    both follow each other.
    Documents without words come the whole number of times. Shares are compared as whole numbers, so
    that no rounding decides. An empty table gives no rows, a table without words takes nothing; NULL doc_ids have a
    place in the order like others; other columns are not read, or with ``keep`` stay together in a column ``row``.
    """
    kept = [F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row")] if keep else []
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"),
        F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string"), F.md5("text"))).alias("draw"),
        *kept,
    )
    rows = stored(rows.withColumn("bin", F.substring("draw", 1, _DIGITS)), "sized")
    bins = stored(rows.groupBy("source", "bin").agg(F.sum("size").alias("words")), "bins")
    targets = _targets(bins.groupBy("source").agg(F.sum("words").alias("source_size")), weights, epochs)

    # Where in the order the rest of a target ends: first the bin, from sums alone, then the document.
    place = W.partitionBy("source").orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    bins = bins.withColumn("before", F.coalesce(F.sum("words").over(place), F.lit(0)))
    bins = bins.join(targets, bins["source"].eqNullSafe(targets["its"]))
    bins = bins.select(
        F.col("source").alias("its"), F.col("bin").alias("its_bin"), "before", "source_size", "target", "whole",
        "rest", "open_weight",
        F.when((F.col("before") + F.col("words")) * F.col("open_weight") <= F.col("rest"), 1)
        .when(F.col("before") * F.col("open_weight") > F.col("rest"), 0).alias("more"),
    )
    rows = rows.join(bins, rows["source"].eqNullSafe(bins["its"]) & (rows["bin"] == bins["its_bin"]))
    order = W.partitionBy("source", "bin").orderBy("draw", F.col("doc_id").asc_nulls_last(), "size")
    inside = F.coalesce(F.sum("size").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    middle = (2 * (F.col("before") + inside) + F.col("size")) * F.col("open_weight")
    # A bin in which the rest ends is at most two of a source; only those are put in order.
    ended = rows.where("more IS NULL").withColumn("more", F.when(middle <= 2 * F.col("rest"), 1).otherwise(0))
    times = (F.col("whole") + F.when(F.col("size") > 0, F.col("more")).otherwise(0)).cast("long")
    return rows.where("more IS NOT NULL").unionByName(ended).select(
        "doc_id", "source", "size", "source_size", "target", times.alias("times"),
        (F.col("size") * times).alias("taken"), *(["row"] if keep else []),
    )


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The documents themselves, each as often as the mixture takes it."""
    chosen = mixture(docs, keep=True, **how).where("times > 0")
    return chosen.select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")


def _targets(sources: DataFrame, weights: tuple[int, ...], epochs: int) -> DataFrame:
    """Per source: ``its`` name, ``target``, how often all of it is taken (``whole``) and what is left.

    ``rest`` is the words left, times ``open_weight``. The windows over all rows order sources, of which there is one
    row each, not documents. With sources in rising order of words per weight, one is capped if the level that those
    not before it would share is not below its cap; those capped come first.
    """
    number = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight: Column = F.lit(weights[-1])
    for k, value in enumerate(weights[:-1]):
        weight = F.when(number % len(weights) == k, value).otherwise(weight)
    whole = lambda column: column.cast(_NUMBER)
    rising = W.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier, later = rising.rowsBetween(W.unboundedPreceding, -1), rising.rowsBetween(0, W.unboundedFollowing)
    everywhere = W.orderBy().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    cap, left = whole(F.col("cap")), F.col("total") - F.col("passed")
    levels = (
        sources.withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * epochs)
        .withColumn("total", whole(F.sum("source_size").over(everywhere)))
        .withColumn("passed", whole(F.coalesce(F.sum("cap").over(earlier), F.lit(0))))
        .withColumn("behind", whole(F.sum("weight").over(later)))
        .withColumn("capped", cap * F.col("behind") <= F.col("weight") * left)
        .withColumn("used", whole(F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(everywhere), F.lit(0))))
        .withColumn("open", F.sum(F.when(~F.col("capped"), F.col("weight"))).over(everywhere))
        .withColumn("share", whole(F.col("weight") * (F.col("total") - F.col("used"))))
    )
    unit = whole(F.col("open") * F.col("source_size"))
    times = F.floor(F.col("share").cast("decimal(38,0)") / unit)
    shares = levels.withColumn("whole", F.when(F.col("capped"), epochs).otherwise(times.cast("int")))
    # The division may have rounded up to the next whole number.
    shares = shares.withColumn(
        "whole", F.when(F.col("capped") | (F.col("whole") * unit <= F.col("share")), F.col("whole")).otherwise(F.col("whole") - 1)
    )
    return shares.select(
        F.col("source").alias("its"),
        "source_size",
        F.when(F.col("capped"), F.col("cap").cast("double"))
        .otherwise(F.col("share").cast("double") / F.col("open").cast("double")).alias("target"),
        "whole",
        F.when(F.col("capped"), F.lit(0).cast(_NUMBER)).otherwise(whole(F.col("share") - F.col("whole") * unit)).alias("rest"),
        whole(F.when(F.col("capped"), 1).otherwise(F.col("open"))).alias("open_weight"),
    )

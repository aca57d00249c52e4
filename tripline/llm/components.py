"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripline.llm.store import stored


def components(links: DataFrame) -> DataFrame:
    """The smallest node that each linked node reaches: columns ``node`` and ``component``.

    ``links`` has columns ``a`` and ``b`` of type long; direction, repeats and loops do not matter, links with a null
    are left out. Alternates two rewritings of the links until they no longer change: every node hands its larger
    neighbours to its smallest one, then its smaller ones. Both keep the components and end in stars. A round is a
    grouped minimum, reduced before it is shuffled, and a join that Spark can split where a node has many links.
    """
    links = stored(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .distinct(),
        "links",
    )
    state, before = _state(links), None
    while state != before and state[0]:
        links = stored(_small_star(_large_star(links)), "links")
        state, before = _state(links), state
    stars = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(links.select(F.col("b"), F.col("b"))).distinct()


def _state(links: DataFrame) -> tuple:
    """Tells whether a round has changed the links."""
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    larger = both.where("v > u").join(least, "u")
    return larger.select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b")


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    smaller = links.join(least, "a")
    pairs = smaller.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return pairs.union(least.select("a", F.col("m").alias("b"))).distinct()

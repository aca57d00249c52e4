"""Bring a built lake up to date with its landing area: find what changed, load that, and rebuild what it reaches.

The lake remembers each landing file it has loaded (path below the landing base, length, time) in a table of its own,
the loads. What changed is a full outer join of that table with the present files; nothing of a file's content is read
for it. A run first lists the files, then loads, and remembers the listing last: one that is cut off finds the same
changes again, and loading them again replaces, never adds.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripline.contract import DEFAULT_YEAR, SILVER_PARTITIONS, Lakehouse, Period, year_months
from tripline.operators.gold import merged_mean, sums_by_month_and_hour
from tripline.plans.layers import create_raw, reload_months, source_months, stored_months
from tripline.plans.tables import (
    OVERWRITE_PARTITIONS,
    build_session,
    drop_partitions,
    remembered_period,
    seen_by,
    write_table,
    write_tables,
)
from tripline.sources.landing import landing_inventory
from tripline.sources.local import local_table
from tripline.sources.scratch import checkpoint_root, new_folder, remove

_STATE = ["length", "modified"]


def listed_files(spark: SparkSession, landing_base: str) -> DataFrame:
    """The landing files as they are now: ``year``, ``month``, ``file`` (path below the base), ``length``, ``modified``."""
    below = F.regexp_extract("path", r"(/year=\d+/month=\d+/.*)$", 1)
    modified = F.unix_micros("modificationTime").alias("modified")
    return landing_inventory(spark, landing_base).where("year IS NOT NULL AND month IS NOT NULL").select(
        "year", "month", below.alias("file"), "length", modified
    )


def remember_loads(files: DataFrame, lake: Lakehouse) -> DataFrame:
    """Store the files that are loaded, in place of those remembered before."""
    return write_table(files.hint("rebalance"), lake, "loads")


def changed_files(files: DataFrame, loads: DataFrame) -> DataFrame:
    """Files that are not as they were loaded: ``year``, ``month``, ``file`` and ``change``.

    ``new`` files were never loaded, ``vanished`` ones are there no more, ``changed`` ones have another length or time.
    """
    keys = ["year", "month", "file"]
    now = files.select(*keys, F.struct(*_STATE).alias("now"))
    then = loads.select(*keys, F.struct(*_STATE).alias("then"))
    change = (
        F.when(F.col("then").isNull(), "new").when(F.col("now").isNull(), "vanished").when(F.col("now") != F.col("then"), "changed")
    )
    return now.join(then, keys, "full_outer").withColumn("change", change).where("change IS NOT NULL").select(*keys, "change")


def changed_months(files: DataFrame, loads: DataFrame) -> DataFrame:
    """Months that must be loaded again: ``year``, ``month`` and ``change``.

    A month is ``new`` or ``vanished`` if all its files are, and ``changed`` if some file is not as it was.
    """
    by_month = changed_files(files, loads).groupBy("year", "month").agg(F.collect_set("change").alias("changes"))
    present = files.groupBy("year", "month").agg(F.lit(True).alias("present"))
    former = loads.groupBy("year", "month").agg(F.lit(True).alias("former"))
    change = F.when(F.col("former").isNull(), "new").when(F.col("present").isNull(), "vanished").otherwise("changed")
    return (
        by_month.join(present, ["year", "month"], "left")
        .join(former, ["year", "month"], "left")
        .select("year", "month", change.alias("change"))
    )


def landing_changes(spark: SparkSession, landing_base: str, lake: Lakehouse = Lakehouse()) -> DataFrame:
    """The months in which the landing area differs from what the lake has loaded."""
    files = listed_files(spark, landing_base)
    return changed_months(files, _loads(spark, lake, files))


def _loads(spark: SparkSession, lake: Lakehouse, like: DataFrame) -> DataFrame:
    """What is remembered; nothing for a lake that has never been refreshed."""
    if spark.catalog.tableExists(lake.table("loads")):
        return seen_by(spark, lake, "loads")
    return spark.createDataFrame([], like.schema)


def refresh_lake(
    spark: SparkSession, landing_base: str, lake: Lakehouse = Lakehouse(), hourly_month: tuple[int, int] = (2023, 5)
) -> DataFrame:
    """Load the months that changed, take out those that vanished, rebuild the silver months they reach and the gold
    sums of these; returns the changes (``year``, ``month``, ``change``).

    The lake is built already and keeps its period: a new month outside it is an error, before anything is changed.
    Raw months that did not change, and silver months that no changed file had or has rows for, are not written.
    """
    checkpoint_root(spark)
    own = build_session(spark)
    folder = new_folder(spark, "listing")
    try:
        # The files as they were before the load began: one that changes meanwhile is found again next time.
        listed_files(spark, landing_base).write.parquet(folder)
        files = spark.read.parquet(folder)
        found = sorted(tuple(row) for row in changed_months(files, _loads(spark, lake, files)).collect())
        load = [(y, m) for y, m, change in found if change != "vanished"]
        vanished = [(y, m) for y, m, change in found if change == "vanished"]
        period = remembered_period(spark, lake) or Period()
        outside = [month for month in load if not period.holds(*month)]
        if outside:
            raise ValueError(f"months {outside} are not in the period from {period.start} to {period.end}")
        if found:
            reload_months(own, landing_base, load, vanished, lake, period)
            refresh_gold(spark, lake, *hourly_month)
            remember_loads(own.read.parquet(folder), lake)
    finally:
        remove(spark, folder)
    return local_table(spark, "year int, month int, change string", found)


def append_new_files(
    spark: SparkSession, landing_base: str, lake: Lakehouse = Lakehouse(), months=None, year: int = DEFAULT_YEAR
) -> DataFrame:
    """Add to raw the months whose files it has not loaded, and return the raw table. Repeating it adds nothing.

    An anti join of the present files with the loads tells what is missing, among ``months`` if given. A month none of
    whose files was loaded is appended. One of which some files are known, or which raw already holds because an earlier
    append was cut off before it was remembered, is replaced, so no row comes in twice.
    """
    checkpoint_root(spark)
    own = build_session(spark)
    folder = new_folder(spark, "listing")
    try:
        listed_files(spark, landing_base).write.parquet(folder)
        files = own.read.parquet(folder)
        asked = files
        if months is not None:
            asked = files.where(reduce(or_, [(F.col("year") == y) & (F.col("month") == m) for y, m in year_months(year, months)]))
        loads = _loads(own, lake, files)
        state = ["year", "month", "file", *_STATE]
        missing = asked.join(loads, state, "left_anti")
        wanted = {tuple(row) for row in missing.select("year", "month").distinct().collect()}
        if wanted:
            held = set(source_months(seen_by(own, lake, "raw"))) if spark.catalog.tableExists(lake.table("raw")) else set()
            for some, mode in ((wanted & held, OVERWRITE_PARTITIONS), (wanted - held, "append")):
                if some:
                    create_raw(spark, landing_base, months=sorted(some), mode=mode, lake=lake)
            loaded = local_table(own, "year int, month int", sorted(wanted))
            others = loads.join(loaded, ["year", "month"], "left_anti").select(*state)
            remember_loads(others.union(files.join(loaded, ["year", "month"], "left_semi").select(*state)), lake)
    finally:
        remove(spark, folder)
    return seen_by(spark, lake, "raw")


def refresh_gold(
    spark: SparkSession, lake: Lakehouse = Lakehouse(), year: int = 2023, month: int = 5
) -> dict[str, DataFrame]:
    """The gold means from stored sums by month and hour; ``year`` and ``month`` are those of the hourly question.

    Builds take out the sums of the silver months they write, so only months without sums are read; months that silver
    does not have any more lose theirs.
    """
    own = build_session(spark)
    silver = seen_by(own, lake, "silver")
    known = spark.catalog.tableExists(lake.table("gold_parts"))
    summed = set(stored_months(seen_by(own, lake, "gold_parts"), SILVER_PARTITIONS)) if known else set()
    present = set(stored_months(silver, SILVER_PARTITIONS))
    if present - summed or not known:
        these = [(F.col("pickup_year") == y) & (F.col("pickup_month") == m) for y, m in sorted(present - summed)]
        sums = sums_by_month_and_hour(silver.where(reduce(or_, these, F.lit(False))))
        write_table(sums.repartition(*SILVER_PARTITIONS), lake, "gold_parts", OVERWRITE_PARTITIONS, SILVER_PARTITIONS)
    drop_partitions(spark, lake, "gold_parts", [dict(zip(SILVER_PARTITIONS, key)) for key in sorted(summed - present)])
    sums = seen_by(own, lake, "gold_parts")
    hourly = sums.where((F.col("pickup_year") == year) & (F.col("pickup_month") == month))
    frames = {
        "gold_monthly": merged_mean(sums, ["pickup_year", "pickup_month"], "total_amount"),
        "gold_hourly": merged_mean(hourly, ["pickup_hour"], "passenger_count"),
    }
    write_tables(frames, lake, "overwrite")
    return {layer: seen_by(spark, lake, layer) for layer in ("gold_monthly", "gold_hourly", "gold_parts")}

"""Build the layers. Every function stores its tables and returns them as stored."""

from __future__ import annotations

import re
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripline.contract import (
    DEFAULT_MONTHS,
    DEFAULT_YEAR,
    GOLD_TRIP_COLUMNS,
    PICKUP,
    RAW_PARTITIONS,
    SILVER_PARTITIONS,
    Lakehouse,
    Period,
    year_months,
)
from tripline.operators.gold import (
    avg_passenger_count_by_hour,
    avg_total_amount_by_month,
    trip_facts,
)
from tripline.operators.quality import (
    QualityError,
    WriteProfile,
    assert_no_rows,
    assert_none_broken,
    assert_required_columns,
)
from tripline.operators.silver import clean_trips, gather_strays
from tripline.plans.tables import (
    OVERWRITE_PARTITIONS,
    build_session,
    drop_partitions,
    layer_tables,
    remember_period,
    remembered_period,
    seen_by,
    write_table,
    write_tables,
)
from tripline.sources.landing import missing_months, read_landing


def create_raw(
    spark: SparkSession,
    landing_base: str,
    year: int = DEFAULT_YEAR,
    months=DEFAULT_MONTHS,
    mode: str = "overwrite",
    lake: Lakehouse = Lakehouse(),
    profile: WriteProfile | None = None,
) -> DataFrame:
    """Landing files to the raw table. A scan task reads one month's file, so no shuffle comes before the write.

    ``months`` are months of ``year``, or (year, month) pairs of several years. A ``profile`` counts the rows written.
    """
    landed = read_landing(build_session(spark), landing_base, year, months)
    write_table(profile.watched(landed) if profile else landed, lake, "raw", mode, RAW_PARTITIONS)
    if mode == OVERWRITE_PARTITIONS:
        # Row counts come from the files' footers.
        held = {tuple(row) for row in landed.select(*RAW_PARTITIONS).distinct().collect()}
        empty = set(year_months(year, months)) - held
        drop_partitions(spark, lake, "raw", [dict(zip(RAW_PARTITIONS, key)) for key in sorted(empty)])
    return seen_by(spark, lake, "raw")


def create_silver(
    spark: SparkSession,
    mode: str = "overwrite",
    lake: Lakehouse = Lakehouse(),
    period: Period | None = None,
    profile: WriteProfile | None = None,
) -> DataFrame:
    """Raw table to the silver table. The period is that of raw's source months, unless one is given.

    It is stored with the table, for months that are replaced later. A raw table of which no row is clean is an
    error: its months are then hardly those of the period. A ``profile`` counts the rows written.
    """
    raw = seen_by(build_session(spark), lake, "raw")
    months = source_months(raw)
    period = period or (Period.covering(months) if months else Period())
    forget_sums(spark, lake)
    laid_out = gather_strays(raw, period, months)
    silver = write_table(profile.watched(laid_out) if profile else laid_out, lake, "silver", mode, SILVER_PARTITIONS)
    remember_period(spark, lake, period)
    if silver.isEmpty() and not raw.isEmpty():
        raise QualityError(f"no row of raw is clean in the period from {period.start} to {period.end}")
    return seen_by(spark, lake, "silver")


def create_gold(
    spark: SparkSession,
    mode: str = "overwrite",
    lake: Lakehouse = Lakehouse(),
    year: int = 2023,
    month: int = 5,
    trips_as: str = "view",
) -> dict[str, DataFrame]:
    """Silver table to the three consumer tables.

    The trip detail is a view on silver: no second copy of all trips is stored, and a filter on ``pickup_year`` and
    ``pickup_month`` reaches silver's partitions. ``trips_as="table"`` stores a copy, partitioned the same way. What
    lies there as the other kind is replaced.
    """
    if trips_as not in ("table", "view"):
        raise ValueError(f"trips_as must be 'table' or 'view', not {trips_as!r}")
    silver = seen_by(build_session(spark), lake, "silver")
    frames = {
        "gold_trips": trip_facts(silver),
        "gold_monthly": avg_total_amount_by_month(silver),
        "gold_hourly": avg_passenger_count_by_hour(silver, year, month),
    }
    trips = lake.table("gold_trips")
    kind = spark.catalog.getTable(trips).tableType if spark.catalog.tableExists(trips) else None
    if trips_as == "view":
        columns = ", ".join(frames.pop("gold_trips").columns)
        if kind not in (None, "VIEW"):
            spark.sql(f"DROP TABLE {trips}")
        spark.sql(f"CREATE OR REPLACE VIEW {trips} AS SELECT {columns} FROM {lake.table('silver')}")
    elif kind == "VIEW":
        spark.sql(f"DROP VIEW {trips}")
    write_tables(frames, lake, mode, {"gold_trips": SILVER_PARTITIONS})
    return {
        "gold_trips_df": seen_by(spark, lake, "gold_trips").select(*GOLD_TRIP_COLUMNS),
        "monthly_avg_df": seen_by(spark, lake, "gold_monthly"),
        "may_hourly_passengers_df": seen_by(spark, lake, "gold_hourly"),
    }


def replace_months(
    spark: SparkSession,
    landing_base: str,
    months,
    year: int = DEFAULT_YEAR,
    lake: Lakehouse = Lakehouse(),
    period: Period | None = None,
) -> DataFrame:
    """Load some months again, leave the others alone, and return the silver table.

    The period is the one silver was built for; another one, or months that it does not hold, is an error, for rows
    outside it would be dropped without a word. ``months`` are as for ``create_raw``.

    A file also holds pickups of other months, so the silver months to rebuild are those that hold rows of the
    old files and those the new files have rows for. They are rebuilt from all of raw and swapped in together.
    A run that is cut off can be repeated: the old months are looked up in silver, which changes last.
    """
    asked = year_months(year, months)
    known = remembered_period(spark, lake)
    if known and period and known != period:
        raise ValueError(f"silver was built for {known}, not for {period}")
    period = period or known or Period()
    outside = [month for month in asked if not period.holds(*month)]
    if outside:
        raise ValueError(f"months {outside} are not in the period from {period.start} to {period.end}")
    reload_months(spark, landing_base, asked, [], lake, period)
    return seen_by(spark, lake, "silver")


def reload_months(
    spark: SparkSession,
    landing_base: str,
    load: list[tuple[int, int]],
    vanished: list[tuple[int, int]],
    lake: Lakehouse,
    period: Period,
) -> set[tuple[int, int]]:
    """Replace and remove source months in raw, and rebuild the pickup months they had or have rows for; returns those."""
    own = build_session(spark)
    reached = reduce(
        or_, [(F.col("source_year") == y) & (F.col("source_month") == month) for y, month in [*load, *vanished]]
    )
    before = pickup_months(seen_by(own, lake, "silver").where(reached))
    if load:
        create_raw(spark, landing_base, months=load, mode=OVERWRITE_PARTITIONS, lake=lake)
    drop_partitions(own, lake, "raw", [dict(zip(RAW_PARTITIONS, month)) for month in vanished])
    raw = seen_by(own, lake, "raw")
    after = pickup_months(clean_trips(raw.where(reached), period))
    if before | after:
        forget_sums(own, lake, before | after)
        rebuilt = raw.where(_picked_up_in(before | after))
        laid_out = gather_strays(rebuilt, period, source_months(raw))
        write_table(laid_out, lake, "silver", OVERWRITE_PARTITIONS, SILVER_PARTITIONS)
    # A month without rows is not overwritten. Only months the new files do not reach can have become empty.
    gone = before - after
    if gone:
        gone -= pickup_months(clean_trips(raw.where(_picked_up_in(gone)), period))
        drop_partitions(own, lake, "silver", [dict(zip(SILVER_PARTITIONS, key)) for key in sorted(gone)])
    return before | after


def source_months(raw: DataFrame) -> list[tuple[int, int]]:
    """The months whose files are in raw: its partitions, without reading a row of them."""
    return [month for month in stored_months(raw, RAW_PARTITIONS) if 1 <= month[1] <= 12]


def stored_months(table: DataFrame, names: tuple[str, str]) -> list[tuple[int, int]]:
    """The partitions of a stored table that have files, by their folders' names; no job is run."""
    pattern = re.compile("/" + "/".join(rf"{name}=(\d+)" for name in names) + "/")
    found = map(pattern.search, table.inputFiles())
    return sorted({tuple(map(int, match.groups())) for match in found if match})


def forget_sums(spark: SparkSession, lake: Lakehouse, months: set[tuple[int, int]] | None = None) -> None:
    """Take out the gold sums of months (all, if None) whose trips are about to change.

    What is cut off in between leaves months without sums, which the next ``refresh_gold`` makes, and never old sums.
    """
    if not spark.catalog.tableExists(lake.table("gold_parts")):
        return
    if months is None:
        months = stored_months(seen_by(spark, lake, "gold_parts"), SILVER_PARTITIONS)
    drop_partitions(spark, lake, "gold_parts", [dict(zip(SILVER_PARTITIONS, month)) for month in sorted(months)])


def pickup_months(silver: DataFrame) -> set[tuple[int, int]]:
    """The pickup months in ``silver``: at most as many as the period has."""
    return {tuple(row) for row in silver.select(*SILVER_PARTITIONS).distinct().collect()}


def _picked_up_in(months: set[tuple[int, int]]) -> Column:
    """A range of pickups per month, which Parquet's row group statistics can be tested against."""

    def within(year: int, month: int) -> Column:
        following = date(year + month // 12, month % 12 + 1, 1)
        pickup = F.col(PICKUP)
        return (pickup >= F.lit(date(year, month, 1)).cast("timestamp")) & (
            pickup < F.lit(following).cast("timestamp")
        )

    return reduce(or_, [within(*key) for key in sorted(months)])


def create_all(
    spark: SparkSession,
    landing_base: str,
    year: int = DEFAULT_YEAR,
    months=DEFAULT_MONTHS,
    lake: Lakehouse = Lakehouse(),
    period: Period | None = None,
    hourly_month: tuple[int, int] = (2023, 5),
    trips_as: str = "view",
) -> dict[str, DataFrame]:
    """Raw, silver and gold in turn, each checked before the next one builds on it.

    The period is that of the months, unless one is given.
    """
    assert_no_rows(missing_months(spark, landing_base, year, months), "months not landed")
    raw = create_raw(spark, landing_base, year, months, lake=lake)
    assert_required_columns(raw)
    period = period or Period.covering(year_months(year, months))
    profile = WriteProfile(period)
    silver = create_silver(spark, lake=lake, period=period, profile=profile)
    assert_required_columns(silver)
    assert_none_broken(profile.broken)  # counted while silver was written
    gold = create_gold(spark, "overwrite", lake, *hourly_month, trips_as)
    assert_no_rows(layer_tables(spark, lake).where("NOT is_present"), "tables missing from the catalog")
    return {"raw_df": raw, "silver_df": silver, **gold}

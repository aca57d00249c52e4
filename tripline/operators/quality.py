"""Validation as tables: profiles computed in one pass, and assertions on top of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tripline.contract import DROPOFF, PICKUP, TRIP_COLUMNS, Period
from tripline.functions import all_of, trip_rules


class QualityError(ValueError):
    """A table does not hold what its layer promises."""


def record_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("record_count"))


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per group, in the order of the keys."""
    return df.groupBy(*keys).count().orderBy(*keys)


def count_by_source_month(df: DataFrame) -> DataFrame:
    return count_by(df, "source_year", "source_month")


def count_by_pickup_month(df: DataFrame) -> DataFrame:
    return count_by(df, "pickup_year", "pickup_month")


def missing_columns(df: DataFrame, required=TRIP_COLUMNS) -> list[str]:
    return [name for name in required if name not in df.columns]


def column_availability(df: DataFrame, required=TRIP_COLUMNS) -> DataFrame:
    """For each required column: is it there, of how many rows, and in how many of them does it hold a value?"""
    present = [name for name in required if name not in missing_columns(df, required)]
    counts = df.agg(
        F.count(F.lit(1)).alias("record_count"),
        *[(F.count(name) if name in present else F.lit(0).cast("bigint")).alias(name) for name in required],
    )
    return counts.unpivot(["record_count"], list(required), "column_name", "value_count").select(
        "column_name", F.col("column_name").isin(present).alias("is_present"), "record_count", "value_count"
    )


def null_counts() -> list[Column]:
    return [F.count_if(F.col(name).isNull()).alias(f"{name}_nulls") for name in TRIP_COLUMNS]


def null_profile(df: DataFrame) -> DataFrame:
    """How many rows have no value, per required column."""
    return df.agg(*null_counts())


def violation_counts() -> list[Column]:
    def rows_where(condition: Column) -> Column:
        return F.sum(F.coalesce(condition, F.lit(False)).cast("int"))

    return [
        F.count(F.lit(1)).alias("total_records"),
        rows_where(F.col("passenger_count") <= 0).alias("invalid_passenger_count"),
        rows_where(F.col("total_amount") < 0).alias("negative_total_amount"),
        rows_where(F.col(DROPOFF) <= F.col(PICKUP)).alias("invalid_trip_time"),
        F.min(PICKUP).alias("min_pickup_datetime"),
        F.max(PICKUP).alias("max_pickup_datetime"),
    ]


def violation_profile(df: DataFrame) -> DataFrame:
    """Row count, rows against each value rule, and the range of pickups.

    The sums are NULL, not 0, for a table without rows.
    """
    return df.agg(*violation_counts())


class WriteProfile:
    """The null and violation profiles of what a build writes, counted by the writing job itself.

    Given to ``create_raw`` or ``create_silver``; afterwards ``nulls`` and ``violations`` hold what ``null_profile`` and
    ``violation_profile`` say of the rows written, and no scan of the stored table is needed. ``broken`` has the rows
    against each rule of the period, as ``reject_profile`` counts them.
    """

    def __init__(self, period: Period | None = None):
        self._observation, self._rules = Observation(), trip_rules(period) if period else {}

    def watched(self, df: DataFrame) -> DataFrame:
        broken = [
            F.count_if(~F.coalesce(rule, F.lit(False))).alias(f"rule {name}") for name, rule in self._rules.items()
        ]
        return df.observe(self._observation, *null_counts(), *violation_counts(), *broken)

    @property
    def nulls(self) -> dict[str, int]:
        return {name: value for name, value in self._observation.get.items() if name.endswith("_nulls")}

    @property
    def broken(self) -> dict[str, int]:
        return {name[5:]: value for name, value in self._observation.get.items() if name.startswith("rule ")}

    @property
    def violations(self) -> dict:
        left = {name: value for name, value in self._observation.get.items() if not name.startswith("rule ")}
        return {name: value for name, value in left.items() if not name.endswith("_nulls")}


def reject_profile(raw: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """Rows each rule turns away, counted in one pass, and the rows that meet all rules (``kept``).

    A row may break several rules and then counts for each.
    """
    rules = trip_rules() if rules is None else rules
    broken = {name: ~F.coalesce(rule, F.lit(False)) for name, rule in rules.items()}
    counts = raw.agg(
        *[F.count_if(condition).alias(name) for name, condition in broken.items()],
        F.count_if(all_of(rules)).alias("kept"),
    )
    return counts.unpivot([], [*broken, "kept"], "rule", "row_count")


def assert_required_columns(df: DataFrame, required=TRIP_COLUMNS) -> None:
    missing = missing_columns(df, required)
    if missing:
        raise QualityError(f"missing required columns: {missing}")


def assert_clean(silver: DataFrame, period: Period = Period()) -> None:
    """Fail unless every row meets every rule. One pass, one row to the driver per rule."""
    assert_required_columns(silver)
    counted = {row["rule"]: row["row_count"] for row in reject_profile(silver, trip_rules(period)).collect()}
    counted.pop("kept")
    assert_none_broken(counted)


def assert_none_broken(counted: dict[str, int]) -> None:
    """Fail if rows against some rule were counted."""
    broken = {rule: rows for rule, rows in counted.items() if rows}
    if broken:
        raise QualityError(f"rows against the rules: {broken}")


def assert_no_rows(df: DataFrame, complaint: str) -> None:
    """Fail if a report that lists problems is not empty. All are named: reports have a row a month, file or table."""
    found = [row.asDict() for row in df.collect()]
    if found:
        raise QualityError(f"{complaint}: {found}")

"""Clean trips to the tables consumers read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripline.contract import GOLD_TRIP_COLUMNS


def trip_facts(silver: DataFrame) -> DataFrame:
    """Trip detail for consumers: the clean columns without lineage and load times."""
    return silver.select(*GOLD_TRIP_COLUMNS)


def mean_by(trips: DataFrame, keys: list[str], measure: str) -> DataFrame:
    """Mean of ``measure`` to two decimals and number of trips per group. Who reads the stored table sorts it.

    Every task first reduces its rows to one partial sum and count per group, so what is shuffled grows with
    the number of tasks and groups only, however large a single group is.
    """
    return trips.groupBy(*keys).agg(
        F.round(F.mean(measure), 2).alias(f"avg_{measure}"),
        F.count(F.lit(1)).alias("trip_count"),
    )


def avg_total_amount_by_month(silver: DataFrame) -> DataFrame:
    """What does a trip cost on average in each month?"""
    return mean_by(silver, ["pickup_year", "pickup_month"], "total_amount")


def avg_passenger_count_by_hour(silver: DataFrame, year: int = 2023, month: int = 5) -> DataFrame:
    """How many passengers does a trip have on average at each hour of the day, within one month?

    The month is chosen by the partition columns, so only that month's files are read.
    """
    one_month = silver.where((F.col("pickup_year") == year) & (F.col("pickup_month") == month))
    return mean_by(one_month, ["pickup_hour"], "passenger_count")


def trip_count_by_month_hour(silver: DataFrame) -> DataFrame:
    """How are trips spread over months and hours?"""
    keys = ["pickup_year", "pickup_month", "pickup_hour"]
    return silver.groupBy(*keys).agg(F.count(F.lit(1)).alias("trip_count"))


# Sums and counts that means are made of, by month and hour.
_MEASURES = ("total_amount", "passenger_count")


def sums_by_month_and_hour(silver: DataFrame) -> DataFrame:
    """One row per month and hour: how many trips, and the sums of what the consumer tables take means of.

    At most 24 rows a month, from which every gold table can be made without reading a trip again. A sum over no value
    is NULL, as its mean is.
    """
    return silver.groupBy("pickup_year", "pickup_month", "pickup_hour").agg(
        F.count(F.lit(1)).alias("trip_count"),
        *(F.sum(name).alias(f"sum_{name}") for name in _MEASURES),
        *(F.count(name).alias(f"count_{name}") for name in _MEASURES),
    )


def merged_mean(sums: DataFrame, keys: list[str], measure: str) -> DataFrame:
    """What ``mean_by`` gives, from the stored sums."""
    mean = F.sum(f"sum_{measure}") / F.nullif(F.sum(f"count_{measure}"), F.lit(0))
    return sums.groupBy(*keys).agg(
        F.round(mean, 2).alias(f"avg_{measure}"), F.sum("trip_count").alias("trip_count")
    )


def merged_count_by_month_hour(sums: DataFrame) -> DataFrame:
    """What ``trip_count_by_month_hour`` gives, from the stored sums."""
    return sums.select("pickup_year", "pickup_month", "pickup_hour", "trip_count")

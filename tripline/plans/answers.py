"""The consumer's SQL over the gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripline.contract import GOLD_TRIP_COLUMNS, Lakehouse


def answer_avg_total_amount_by_month(spark: SparkSession, lake: Lakehouse = Lakehouse()) -> DataFrame:
    return spark.sql(f"""
        SELECT pickup_year, pickup_month, avg_total_amount, trip_count
        FROM {lake.table("gold_monthly")} ORDER BY pickup_year, pickup_month""")


def answer_avg_passenger_count_by_hour(spark: SparkSession, lake: Lakehouse = Lakehouse()) -> DataFrame:
    return spark.sql(f"""
        SELECT pickup_hour, avg_passenger_count, trip_count
        FROM {lake.table("gold_hourly")} ORDER BY pickup_hour""")


def first_trips(spark: SparkSession, lake: Lakehouse = Lakehouse(), rows: int = 100) -> DataFrame:
    """Any ``rows`` trips, in the documented column order."""
    return spark.sql(f"SELECT {', '.join(GOLD_TRIP_COLUMNS)} FROM {lake.table('gold_trips')} LIMIT {int(rows)}")

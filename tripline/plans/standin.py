"""Trips made from the ``events`` table, for data folders that hold no trip files.

Events are moved to pickups from January to June 2023 (some a year early), spread over five monthly files, and
some rows are given each defect the quality rules know. The same text serves Spark and the SQL oracle; only
three functions are spelled differently.
"""

from __future__ import annotations

from string import Template
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripline.contract import (
    DEFAULT_MONTHS,
    DEFAULT_YEAR,
    Lakehouse,
    landed_path,
)
from tripline.plans.layers import create_gold, create_raw, create_silver
from tripline.sources.filesystem import delete, exists, file_states, make_folder, rename
from tripline.sources.local import side_by_side
from tripline.sources.scratch import new_folder

_TRIPS = Template("""
WITH moved AS (
  SELECT *,
    CASE WHEN event_id % 67 = 0 THEN NULL
         ELSE ts + ${months}CAST(event_id % 6 AS INT) - CASE WHEN event_id % 73 = 0 THEN 24 ELSE 12 END)
    END AS pickup
  FROM ${events})
SELECT
  CASE WHEN event_id % 41 = 0 THEN NULL ELSE user_id % 2 + 1 END AS VendorID,
  CASE WHEN event_id % 29 = 0 THEN NULL
       WHEN event_id % 31 = 0 THEN CAST(0 AS DOUBLE)
       WHEN event_id % 37 = 0 THEN CAST(-1 AS DOUBLE)
       ELSE CAST(user_id % 6 + 1 AS DOUBLE) END AS passenger_count,
  CASE WHEN event_id % 43 = 0 THEN NULL WHEN event_id % 47 = 0 THEN -value ELSE value END AS total_amount,
  pickup AS tpep_pickup_datetime,
  CASE WHEN event_id % 53 = 0 THEN NULL
       WHEN event_id % 59 = 0 THEN pickup
       WHEN event_id % 61 = 0 THEN pickup - INTERVAL '10' MINUTE
       ELSE pickup + ${duration} END AS tpep_dropoff_datetime,
  2023 AS source_year,
  CAST(CASE WHEN event_id % 71 = 0 THEN (event_id % 6 + 1) % 5 + 1
            ELSE least(event_id % 6 + 1, 5) END AS INT) AS source_month,
  event_type, props
FROM moved""")

ORACLE_TRIPS = _TRIPS.substitute(
    events="events",
    months="to_months(",
    duration="to_minutes(CAST(event_id % 90 + 1 AS INT)) + to_milliseconds(event_id % 60000)",
)


def standin_trips(events: DataFrame) -> DataFrame:
    """Trips as their publisher would have them, with two columns no layer asks for."""
    text = _TRIPS.substitute(
        events="{events}",
        months="make_ym_interval(0, ",
        duration="make_dt_interval(0, 0, CAST(event_id % 90 + 1 AS INT), "
        "CAST(event_id % 60000 AS DECIMAL(18,6)) / 1000)",
    )
    return events.sparkSession.sql(text, events=events)


def write_landing(trips: DataFrame, base: str, months=DEFAULT_MONTHS, year: int = DEFAULT_YEAR) -> str:
    """Write monthly files whose types drift: from February on, vendors and passengers are other integers.

    Trips are read once for each set of types, not for each month: a month's folder is renamed to its place.
    """
    spark, months = trips.sparkSession, list(months)
    staged = f"{base}/.{uuid4().hex}"

    def write(types: tuple[str, str]) -> None:
        vendor, passengers = types
        own = [month for month in months if (month == 1) == (vendor == "bigint")]
        if not own:
            return
        rows = trips.where(F.col("source_month").isin(own)).withColumns(
            {
                "VendorID": F.col("VendorID").cast(vendor),
                "passenger_count": F.col("passenger_count").cast(passengers),
                "folder": F.col("source_month"),
            }
        )
        rows = rows.drop("source_year", "source_month")
        rows.write.partitionBy("folder").parquet(f"{staged}/{vendor}")
        for month in own:
            target, folder = landed_path(base, year, month), f"{staged}/{vendor}/folder={month}"
            if exists(spark, target):
                raise FileExistsError(target)
            if exists(spark, folder):
                make_folder(spark, target.rsplit("/", 1)[0])
                rename(spark, folder, target)
            else:  # a month without trips
                rows.limit(0).drop("folder").write.parquet(target)

    side_by_side(spark, write, [("bigint", "double"), ("int", "bigint")])
    delete(spark, staged)
    return base


class Standin:
    """Landing files and layer tables made from the events of one data folder, each built when first asked for."""

    _known: dict[tuple, Standin] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.trips = standin_trips(spark.read.parquet(f"{sf_dir}/events.parquet"))
        self._landing: str | None = None
        self._lake: Lakehouse | None = None
        self._tables: dict[str, str] = {}

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Standin:
        """One stand-in per application and state of the events' files, so that its layers are written once."""
        folder = sf_dir.rstrip("/")
        key = (spark.sparkContext.applicationId, folder, *file_states(spark, f"{folder}/events.parquet"))
        if key not in cls._known:
            cls._known[key] = cls(spark, folder)
        return cls._known[key]

    @property
    def landing(self) -> str:
        if self._landing is None:
            self._landing = write_landing(self.trips, new_folder(self.spark, "landing"))
        return self._landing

    def new_lake(self) -> Lakehouse:
        """An empty database of its own below the shared folder."""
        folder = new_folder(self.spark, "lake")
        return Lakehouse(database=f"trips_{folder[-32:]}", location=folder)

    @property
    def lake(self) -> Lakehouse:
        if self._lake is None:
            self._lake = self.new_lake()
        return self._lake

    def _stored(self, layer: str, create) -> DataFrame:
        if layer not in self._tables:
            create()
            self._tables[layer] = self.lake.table(layer)
        return self.spark.table(self._tables[layer])

    def raw(self) -> DataFrame:
        return self._stored("raw", lambda: create_raw(self.spark, self.landing, lake=self.lake))

    def silver(self) -> DataFrame:
        self.raw()
        return self._stored("silver", lambda: create_silver(self.spark, lake=self.lake))

    def gold(self) -> Lakehouse:
        self.silver()
        self._stored("gold_trips", lambda: create_gold(self.spark, lake=self.lake))
        return self.lake


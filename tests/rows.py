"""Single trips for unit tests: one valid trip, and variations of it."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import types as T

from tripline.contract import LINEAGE_TYPES, TRIP_TYPES

RAW_SCHEMA = T.StructType([T.StructField(name, kind) for name, kind in (TRIP_TYPES | LINEAGE_TYPES).items()])


def at(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


VALID = {
    "VendorID": 1,
    "passenger_count": 1.0,
    "total_amount": 10.0,
    "tpep_pickup_datetime": at("2023-03-01 10:00:00"),
    "tpep_dropoff_datetime": at("2023-03-01 10:30:00"),
    "source_year": 2023,
    "source_month": 3,
    "source_file": "march",
    "raw_loaded_at": at("2023-06-02 00:00:00"),
}


def raw_rows(spark, *changes: dict):
    """One row per set of changes to the valid trip."""
    rows = [tuple((VALID | change)[name] for name in RAW_SCHEMA.names) for change in changes]
    return spark.createDataFrame(rows, RAW_SCHEMA)

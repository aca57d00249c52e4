"""The data contract every layer shares: columns, types, period, file layout and table names."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The business columns a monthly file must hold, and the type each is stored in.
TRIP_TYPES: dict[str, T.DataType] = {
    "VendorID": T.IntegerType(),
    "passenger_count": T.DoubleType(),
    "total_amount": T.DoubleType(),
    "tpep_pickup_datetime": T.TimestampType(),
    "tpep_dropoff_datetime": T.TimestampType(),
}
TRIP_COLUMNS = list(TRIP_TYPES)
PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"

# Where each row came from.
LINEAGE_TYPES: dict[str, T.DataType] = {
    "source_year": T.IntegerType(),
    "source_month": T.IntegerType(),
    "source_file": T.StringType(),
    "raw_loaded_at": T.TimestampType(),
}

# The consumer's trip table, in this order.
GOLD_TRIP_COLUMNS = [
    *TRIP_COLUMNS,
    "pickup_date",
    "pickup_year",
    "pickup_month",
    "pickup_day",
    "pickup_hour",
    "trip_duration_minutes",
]

RAW_PARTITIONS = ("source_year", "source_month")
SILVER_PARTITIONS = ("pickup_year", "pickup_month")

# The printf patterns of a monthly file at its publisher and in the landing area.
PUBLISHED_FILE = "%s/yellow_tripdata_%d-%02d.parquet"
LANDED_FILE = "%s/year=%d/month=%02d/yellow_tripdata_%d-%02d.parquet"

DEFAULT_YEAR = 2023
DEFAULT_MONTHS = (1, 2, 3, 4, 5)


def landed_path(base: str, year: int, month: int) -> str:
    """Where the file of one month lies below ``base``."""
    return LANDED_FILE % (base.rstrip("/"), year, month, year, month)


def landed_path_column(base: str, year: Column, month: Column) -> Column:
    """``landed_path`` as a column, for a scan that covers several months."""
    return F.format_string(LANDED_FILE, F.lit(base.rstrip("/")), year, month, year, month)


def published_url_column(base: str, year: Column, month: Column) -> Column:
    """The publisher's address of one monthly file."""
    return F.format_string(PUBLISHED_FILE, F.lit(base.rstrip("/")), year, month)


def as_months(months) -> list[int]:
    """Months as distinct integers; ``"05"`` is accepted for 5."""
    found = [int(month) for month in months]
    if not found:
        raise ValueError("at least one month is required")
    if len(set(found)) < len(found):
        raise ValueError(f"months are listed twice: {found}")
    if not all(1 <= month <= 12 for month in found):
        raise ValueError(f"months must lie between 1 and 12: {found}")
    return found


def year_months(year: int, months) -> list[tuple[int, int]]:
    """Distinct (year, month) pairs; a month without a year of its own is one of ``year``."""
    pairs = [tuple(month) if isinstance(month, (tuple, list)) else (year, month) for month in months]
    years = sorted({int(own) for own, _ in pairs})
    found = [(own, month) for own in years for month in as_months(m for y, m in pairs if int(y) == own)]
    if not found:
        raise ValueError("at least one month is required")
    return found


@dataclass(frozen=True)
class Period:
    """Pickup days that count, from ``start`` up to but not including ``end``."""

    start: date = date(2023, 1, 1)
    end: date = date(2023, 6, 1)

    @classmethod
    def covering(cls, months: list[tuple[int, int]]) -> Period:
        """The days from the first to the last of some (year, month) pairs."""
        (first_year, first), (year, month) = min(months), max(months)
        return cls(date(first_year, first, 1), date(year + month // 12, month % 12 + 1, 1))

    def holds(self, year: int, month: int) -> bool:
        """Whether all days of a month count."""
        whole = Period.covering([(year, month)])
        return self.start <= whole.start and whole.end <= self.end

    def first_instant(self) -> Column:
        return F.lit(self.start).cast("timestamp")

    def end_instant(self) -> Column:
        return F.lit(self.end).cast("timestamp")


@dataclass(frozen=True)
class Lakehouse:
    """Where the layers are stored. ``location`` is the database folder, if not the warehouse default."""

    database: str = "trip_lakehouse"
    location: str | None = None
    storage: str = "parquet"
    raw: str = "raw_yellow_taxi_trips"
    silver: str = "silver_yellow_taxi_trips"
    gold_trips: str = "gold_yellow_taxi_trips"
    gold_monthly: str = "gold_avg_total_amount_by_month"
    gold_hourly: str = "gold_avg_passenger_count_may_by_hour"
    gold_parts: str = "gold_sums_by_month_and_hour"
    loads: str = "landing_loads"

    def table(self, layer: str) -> str:
        return f"{self.database}.{getattr(self, layer)}"

    def table_names(self) -> list[str]:
        return [self.raw, self.silver, self.gold_trips, self.gold_monthly, self.gold_hourly]

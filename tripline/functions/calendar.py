"""Calendar and duration columns, all evaluated in the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_PARTS = {
    "date": F.to_date,
    "year": F.year,
    "month": F.month,
    "day": F.dayofmonth,
    "hour": F.hour,
}


def calendar_parts(name: str, prefix: str) -> dict[str, Column]:
    """``<prefix>_date``, ``_year``, ``_month``, ``_day`` and ``_hour`` of the timestamp column ``name``."""
    return {f"{prefix}_{part}": take(F.col(name)) for part, take in _PARTS.items()}


def minutes_between(start: str, end: str) -> Column:
    """Minutes from ``start`` to ``end``. Both are cut to whole seconds before they are subtracted."""
    return (F.unix_seconds(F.col(end)) - F.unix_seconds(F.col(start))) / F.lit(60)

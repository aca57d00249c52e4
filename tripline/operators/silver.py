"""Raw trips to clean trips."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripline.contract import DROPOFF, LINEAGE_TYPES, PICKUP, TRIP_TYPES, Period
from tripline.functions import all_of, calendar_parts, minutes_between, trip_rules, typed


def clean_trips(
    raw: DataFrame, period: Period = Period(), rules: dict[str, Column] | None = None
) -> DataFrame:
    """The rows of ``raw`` that meet every rule, with calendar parts of the pickup and the duration.

    A row that breaks a rule is left out, never repaired. The month of a trip is the month of its pickup,
    whichever file it came in. Scan, filter and projection are one stage without a shuffle.
    """
    return (
        raw.select(*typed(TRIP_TYPES | LINEAGE_TYPES))
        .where(all_of(trip_rules(period) if rules is None else rules))
        .withColumns(
            calendar_parts(PICKUP, "pickup")
            | {
                "trip_duration_minutes": minutes_between(PICKUP, DROPOFF),
                "silver_loaded_at": F.current_timestamp(),
            }
        )
    )


def gather_strays(
    raw: DataFrame, period: Period = Period(), months: list[tuple[int, int]] = ()
) -> DataFrame:
    """The clean trips of ``raw`` laid out for a write by pickup month, without moving the bulk of them.

    Nearly all trips lie in the file of their pickup month. A task that scans such a file already holds one month and
    can write it as it is. Only the strays, which would leave a small file per task and month, are shuffled together;
    the rebalance hint splits a month that is too large for one task.

    ``months`` are source months of ``raw``. Strays are looked for a month at a time, by pickups before or after it:
    that reads one partition, and in it only the row groups whose statistics reach outside the month. Rows of other
    source months, or of none, are searched in full.
    """
    at_home = F.col("pickup_year").eqNullSafe(F.col("source_year")) & F.col("pickup_month").eqNullSafe(
        F.col("source_month")
    )
    listed, branches = F.lit(False), []
    for year, month in months:
        own = (F.col("source_year") == year) & (F.col("source_month") == month)
        inside = Period.covering([(year, month)])
        outside = (F.col(PICKUP) < inside.first_instant()) | (F.col(PICKUP) >= inside.end_instant())
        branches.append(raw.where(own & outside))
        listed = listed | F.coalesce(own, F.lit(False))
    branches.append(raw.where(~listed))
    # The rules and columns are told once for all branches; the optimizer takes them down to every scan.
    strays = clean_trips(reduce(DataFrame.unionAll, branches), period).where(~at_home)
    return clean_trips(raw, period).where(at_home).unionByName(strays.hint("rebalance", "pickup_year", "pickup_month"))

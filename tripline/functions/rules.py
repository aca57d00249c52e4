"""The quality rules, declared once. The silver filter, the reject report and the assertions all use them."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripline.contract import DROPOFF, PICKUP, TRIP_COLUMNS, Period


def trip_rules(period: Period = Period(), finite: bool = False) -> dict[str, Column]:
    """Rule name to the condition a valid trip meets.

    NaN counts as larger than every number, so it passes the two sign rules; ``finite=True`` adds rules
    that turn it away. A condition that is NULL means the rule is not met.
    """
    pickup = F.col(PICKUP)
    rules = {f"{name}_present": F.col(name).isNotNull() for name in TRIP_COLUMNS}
    rules["pickup_not_before_period"] = pickup >= period.first_instant()
    rules["pickup_before_period_end"] = pickup < period.end_instant()
    rules["dropoff_after_pickup"] = F.col(DROPOFF) > pickup
    rules["passenger_count_positive"] = F.col("passenger_count") > 0
    rules["total_amount_not_negative"] = F.col("total_amount") >= 0
    if finite:
        for name in ("passenger_count", "total_amount"):
            rules[f"{name}_is_number"] = ~F.isnan(name)
    return rules


def all_of(rules: dict[str, Column]) -> Column:
    """One condition that holds where every rule holds."""
    return reduce(and_, rules.values())

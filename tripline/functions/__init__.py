"""Column expressions: types, calendar parts and quality rules."""

from tripline.functions.calendar import calendar_parts, minutes_between
from tripline.functions.casting import typed
from tripline.functions.rules import all_of, trip_rules

__all__ = ["all_of", "calendar_parts", "minutes_between", "trip_rules", "typed"]

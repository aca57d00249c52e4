"""Building, storing and querying the layers."""

from tripline.plans.answers import (
    answer_avg_passenger_count_by_hour,
    answer_avg_total_amount_by_month,
    first_trips,
)
from tripline.plans.layers import create_all, create_gold, create_raw, create_silver, replace_months
from tripline.plans.refresh import (
    append_new_files,
    landing_changes,
    listed_files,
    refresh_gold,
    refresh_lake,
    remember_loads,
)
from tripline.plans.tables import layer_tables, write_table

__all__ = [
    "answer_avg_passenger_count_by_hour",
    "answer_avg_total_amount_by_month",
    "append_new_files",
    "create_all",
    "create_gold",
    "create_raw",
    "create_silver",
    "first_trips",
    "landing_changes",
    "layer_tables",
    "listed_files",
    "refresh_gold",
    "refresh_lake",
    "remember_loads",
    "replace_months",
    "write_table",
]

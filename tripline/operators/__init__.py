"""DataFrame to DataFrame: cleaning, consumer tables and validation."""

from tripline.operators.gold import (
    avg_passenger_count_by_hour,
    avg_total_amount_by_month,
    mean_by,
    merged_count_by_month_hour,
    merged_mean,
    sums_by_month_and_hour,
    trip_count_by_month_hour,
    trip_facts,
)
from tripline.operators.quality import (
    QualityError,
    WriteProfile,
    assert_clean,
    assert_no_rows,
    assert_required_columns,
    column_availability,
    count_by,
    count_by_pickup_month,
    count_by_source_month,
    null_profile,
    record_count,
    reject_profile,
    violation_profile,
)
from tripline.operators.silver import clean_trips, gather_strays

__all__ = [
    "QualityError",
    "WriteProfile",
    "assert_clean",
    "assert_no_rows",
    "assert_required_columns",
    "avg_passenger_count_by_hour",
    "avg_total_amount_by_month",
    "clean_trips",
    "column_availability",
    "count_by",
    "count_by_pickup_month",
    "count_by_source_month",
    "gather_strays",
    "mean_by",
    "merged_count_by_month_hour",
    "merged_mean",
    "null_profile",
    "record_count",
    "reject_profile",
    "sums_by_month_and_hour",
    "trip_count_by_month_hour",
    "trip_facts",
    "violation_profile",
]

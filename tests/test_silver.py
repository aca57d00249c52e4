from __future__ import annotations

import math
from datetime import date, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.rows import VALID, at, raw_rows
from tripline.contract import DROPOFF, PICKUP, TRIP_COLUMNS, Period
from tripline.functions import trip_rules
from tripline.operators import clean_trips, gather_strays, reject_profile

NAN = float("nan")


def trip(pickup: str, dropoff: str) -> dict:
    return {PICKUP: at(pickup), DROPOFF: at(dropoff)}


CASES = [
    *[({name: None}, None) for name in TRIP_COLUMNS],
    ({}, 30.0),
    ({"passenger_count": 0.0}, None),
    ({"passenger_count": -1.0}, None),
    ({"passenger_count": 0.5}, 30.0),
    ({"passenger_count": NAN}, 30.0),
    ({"total_amount": 0.0}, 30.0),
    ({"total_amount": -0.0}, 30.0),
    ({"total_amount": -0.01}, None),
    ({"total_amount": NAN}, 30.0),
    (trip("2023-01-01 00:00:00", "2023-01-01 00:01:00"), 1.0),
    (trip("2022-12-31 23:59:59.999999", "2023-01-01 00:01:00"), None),
    (trip("2023-05-31 23:59:59.999999", "2023-06-01 00:59:59"), 60.0),
    (trip("2023-06-01 00:00:00", "2023-06-01 00:10:00"), None),
    (trip("2023-03-01 10:00:00", "2023-03-01 10:00:00"), None),
    (trip("2023-03-01 10:00:00", "2023-03-01 09:59:59"), None),
    (trip("2023-03-01 10:00:00", "2023-03-01 10:00:00.000001"), 0.0),
    (trip("2023-03-01 10:00:00.9", "2023-03-01 10:01:00.1"), 1.0),
    (trip("2023-03-01 10:00:00", "2023-04-29 10:00:00"), 59 * 24 * 60.0),
]


@pytest.mark.parametrize("change,minutes", CASES)
def test_one_trip(spark, change, minutes):
    kept = [row.trip_duration_minutes for row in clean_trips(raw_rows(spark, change)).collect()]
    assert kept == ([] if minutes is None else [minutes])


def test_calendar_parts_come_from_the_pickup_not_from_the_file(spark):
    change = trip("2023-02-28 23:59:59", "2023-03-01 00:20:00") | {"source_month": 1}
    row = clean_trips(raw_rows(spark, change)).collect()[0]
    assert (row.pickup_date, row.pickup_year, row.pickup_month, row.pickup_day, row.pickup_hour) == (
        date(2023, 2, 28), 2023, 2, 28, 23)
    assert (row.source_year, row.source_month, row.source_file) == (2023, 1, "march")


def test_schema(spark):
    assert clean_trips(raw_rows(spark, {})).dtypes == [
        ("VendorID", "int"), ("passenger_count", "double"), ("total_amount", "double"),
        ("tpep_pickup_datetime", "timestamp"), ("tpep_dropoff_datetime", "timestamp"),
        ("source_year", "int"), ("source_month", "int"), ("source_file", "string"), ("raw_loaded_at", "timestamp"),
        ("pickup_date", "date"), ("pickup_year", "int"), ("pickup_month", "int"), ("pickup_day", "int"),
        ("pickup_hour", "int"), ("trip_duration_minutes", "double"), ("silver_loaded_at", "timestamp"),
    ]


def test_untyped_input_is_cast_and_what_does_not_fit_is_dropped(spark):
    raw = raw_rows(spark, {}, {}, {}).withColumn("VendorID", F.lit("2")).withColumn("surplus", F.lit("x"))
    assert [row.VendorID for row in clean_trips(raw).collect()] == [2, 2, 2]
    assert clean_trips(raw.withColumn("VendorID", F.lit("two"))).count() == 0
    assert clean_trips(raw.withColumn("VendorID", F.lit(3e9))).count() == 0


def test_other_period_and_rules(spark):
    raw = raw_rows(spark, {}, trip("2024-02-01 00:00:00", "2024-02-01 01:00:00"))
    assert [row.pickup_year for row in clean_trips(raw, Period(date(2024, 1, 1), date(2025, 1, 1))).collect()] == [2024]
    nan = raw_rows(spark, {"passenger_count": NAN}, {"total_amount": NAN}, {})
    assert clean_trips(nan).count() == 3
    assert clean_trips(nan, rules=trip_rules(finite=True)).count() == 1


def test_gathering_strays_keeps_every_row(spark):
    months = [{PICKUP: at(f"2023-0{m}-10 10:00:00"), DROPOFF: at("2023-06-01 00:00:00")} for m in (1, 2, 3, 3, 4)]
    silver = clean_trips(raw_rows(spark, *months, {"source_month": None}, {"source_year": None, "source_month": None}))
    rows = sorted(silver.drop("silver_loaded_at").collect(), key=repr)
    assert len(rows) == 7
    assert sorted(gather_strays(silver).drop("silver_loaded_at").collect(), key=repr) == rows


moments = st.integers(-90, 100).flatmap(
    lambda minutes: st.sampled_from([0, 1, 999_999, 1_000_000]).map(
        lambda micros: at("2023-01-01 00:00:00") + timedelta(minutes=minutes, microseconds=micros)
    )
)
numbers = st.sampled_from([None, NAN, -1.0, -0.0, 0.0, 0.25, 3.0])
trips = st.fixed_dictionaries({
    "VendorID": st.sampled_from([None, 1, 2]),
    "passenger_count": numbers,
    "total_amount": numbers,
    PICKUP: st.none() | moments,
    DROPOFF: st.none() | moments,
})


def broken_rules(row: dict) -> set[str]:
    """The rules again, row by row in plain Python."""
    broken = {f"{name}_present" for name in TRIP_COLUMNS if row[name] is None}
    pickup, dropoff = row[PICKUP], row[DROPOFF]
    if pickup is None or pickup < at("2023-01-01 00:00:00"):
        broken.add("pickup_not_before_period")
    if pickup is None or pickup >= at("2023-06-01 00:00:00"):
        broken.add("pickup_before_period_end")
    if pickup is None or dropoff is None or dropoff <= pickup:
        broken.add("dropoff_after_pickup")
    passengers, amount = row["passenger_count"], row["total_amount"]
    if passengers is None or (not math.isnan(passengers) and passengers <= 0):
        broken.add("passenger_count_positive")
    if amount is None or (not math.isnan(amount) and amount < 0):
        broken.add("total_amount_not_negative")
    return broken


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(trips, min_size=1, max_size=40))
def test_rules_agree_with_plain_python(spark, rows):
    raw = raw_rows(spark, *[VALID | row for row in rows])
    counted = {row.rule: row.row_count for row in reject_profile(raw).collect()}
    broken = [broken_rules(row) for row in rows]
    assert counted.pop("kept") == sum(not rules for rules in broken) == clean_trips(raw).count()
    assert counted == {rule: sum(rule in rules for rules in broken) for rule in trip_rules()}

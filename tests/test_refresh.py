"""A lake that is brought up to date by what changed in its landing area."""

from __future__ import annotations

import os
import shutil
import sys
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.test_layers import lake, land, months_of, without_load_times  # noqa: F401
from tests.rows import at
from tripline.contract import DROPOFF, PICKUP, landed_path
from tripline.operators import (
    avg_passenger_count_by_hour,
    avg_total_amount_by_month,
    count_by_source_month,
    merged_count_by_month_hour,
    merged_mean,
    sums_by_month_and_hour,
    trip_count_by_month_hour,
)
from tripline.plans import (
    append_new_files,
    create_raw,
    create_silver,
    landing_changes,
    listed_files,
    refresh_gold,
    refresh_lake,
    remember_loads,
)
from tripline.plans.layers import forget_sums
from tripline.plans.standin import Standin
from tripline.plans.tables import seen_by


def trip(pickup: str, amount: float = 10.0) -> dict:
    return {PICKUP: at(pickup), DROPOFF: at(pickup) + timedelta(minutes=20), "total_amount": amount}


def changes(df):
    return sorted(map(tuple, df.select("year", "month", "change").collect()))


def counts(raw):
    return [tuple(row) for row in count_by_source_month(raw).collect()]


@pytest.fixture
def base(spark, tmp_path):
    base = land(spark, tmp_path / "landing", 1, trip(pickup="2023-01-05 10:00:00"), trip(pickup="2023-02-01 00:30:00"))
    land(spark, base, 2, trip(pickup="2023-02-07 11:00:00"))
    return land(spark, base, 3, trip(pickup="2023-03-07 11:00:00"), trip(pickup="2023-03-08 11:00:00"))


def build(spark, base, lake):  # noqa: F811
    remember_loads(listed_files(spark, base), lake)
    create_raw(spark, base, months=[1, 2, 3], lake=lake)
    create_silver(spark, lake=lake)
    refresh_gold(spark, lake, year=2023, month=3)


def same_as_rebuilt(spark, lake):  # noqa: F811
    """Silver and gold are what the raw table gives from scratch."""
    from tripline.operators import clean_trips
    from tripline.plans.tables import remembered_period

    silver = seen_by(spark, lake, "silver")
    wanted = clean_trips(seen_by(spark, lake, "raw"), remembered_period(spark, lake))
    assert without_load_times(silver) == without_load_times(wanted.select(*silver.columns))
    gold = seen_by(spark, lake, "gold_monthly")
    assert sorted(map(tuple, gold.collect())) == sorted(map(tuple, avg_total_amount_by_month(wanted).collect()))
    hourly = wanted.where("pickup_year = 2023 AND pickup_month = 3")
    found = sorted(map(tuple, seen_by(spark, lake, "gold_hourly").collect()))
    assert found == sorted(map(tuple, avg_passenger_count_by_hour(hourly, 2023, 3).collect()))


def test_nothing_changed(spark, base, lake):  # noqa: F811
    build(spark, base, lake)
    assert changes(landing_changes(spark, base, lake)) == []
    before = seen_by(spark, lake, "silver").select("silver_loaded_at").distinct().collect()
    assert changes(refresh_lake(spark, base, lake, (2023, 3))) == []
    assert seen_by(spark, lake, "silver").select("silver_loaded_at").distinct().collect() == before


def test_new_changed_and_vanished_months(spark, base, lake):  # noqa: F811
    build(spark, base, lake)
    untouched = seen_by(spark, lake, "silver").where("pickup_month = 3").select("silver_loaded_at").first()
    shutil.rmtree(landed_path(base, 2023, 1))
    shutil.rmtree(landed_path(base, 2023, 2))
    land(spark, base, 2, trip(pickup="2023-02-07 11:00:00", amount=50.0), trip(pickup="2023-02-09 11:00:00"))
    wanted = [(2023, 1, "vanished"), (2023, 2, "changed")]
    assert changes(landing_changes(spark, base, lake)) == wanted
    assert changes(refresh_lake(spark, base, lake, (2023, 3))) == wanted
    assert months_of(seen_by(spark, lake, "silver")) == {(2023, 2): 2, (2023, 3): 2}  # January's strays went with it
    assert seen_by(spark, lake, "silver").where("pickup_month = 3").select("silver_loaded_at").first() == untouched
    same_as_rebuilt(spark, lake)
    assert changes(landing_changes(spark, base, lake)) == []


def test_a_part_that_is_added(spark, base, lake):  # noqa: F811
    build(spark, base, lake)
    part = spark.read.parquet(landed_path(base, 2023, 3)).limit(1)
    part.write.mode("append").parquet(landed_path(base, 2023, 3))
    assert changes(landing_changes(spark, base, lake)) == [(2023, 3, "changed")]
    refresh_lake(spark, base, lake, (2023, 3))
    assert counts(seen_by(spark, lake, "raw"))[-1] == (2023, 3, 3)
    same_as_rebuilt(spark, lake)


def test_the_same_bytes_at_another_time(spark, base, lake):  # noqa: F811
    build(spark, base, lake)
    file = next(os.path.join(landed_path(base, 2023, 2), name) for name in os.listdir(landed_path(base, 2023, 2)) if name.startswith("part"))
    os.utime(file, (1_700_000_000, 1_700_000_000))
    assert changes(landing_changes(spark, base, lake)) == [(2023, 2, "changed")]


def test_a_month_outside_the_period_changes_nothing(spark, base, lake):  # noqa: F811
    build(spark, base, lake)
    land(spark, base, 7, trip(pickup="2023-07-07 11:00:00"))
    with pytest.raises(ValueError, match="not in the period"):
        refresh_lake(spark, base, lake)
    assert changes(landing_changes(spark, base, lake)) == [(2023, 7, "new")]
    assert len(counts(seen_by(spark, lake, "raw"))) == 3


@pytest.mark.parametrize("step", ["reload_months", "refresh_gold", "remember_loads"])
def test_a_refresh_that_is_cut_off_is_repeated(spark, base, lake, monkeypatch, step):  # noqa: F811
    module = sys.modules["tripline.plans.refresh"]
    build(spark, base, lake)
    shutil.rmtree(landed_path(base, 2023, 1))
    land(spark, base, 1, trip(pickup="2023-01-09 10:00:00", amount=70.0))
    with monkeypatch.context() as patched:
        patched.setattr(module, step, lambda *_: (_ for _ in ()).throw(SystemExit))
        with pytest.raises(SystemExit):
            refresh_lake(spark, base, lake, (2023, 3))
    assert changes(landing_changes(spark, base, lake)) == [(2023, 1, "changed")]
    refresh_lake(spark, base, lake, (2023, 3))
    assert changes(landing_changes(spark, base, lake)) == []
    same_as_rebuilt(spark, lake)


def test_appending_again_adds_nothing(spark, base, lake):  # noqa: F811
    for months in ([1], [1], [1, 2], None, None):
        raw = append_new_files(spark, base, lake, months)
    assert counts(raw) == [(2023, 1, 2), (2023, 2, 1), (2023, 3, 2)]
    part = spark.read.parquet(landed_path(base, 2023, 3)).limit(1)
    part.write.mode("append").parquet(landed_path(base, 2023, 3))
    assert counts(append_new_files(spark, base, lake))[-1] == (2023, 3, 3)


def test_an_append_cut_off_before_it_was_remembered(spark, base, lake, monkeypatch):  # noqa: F811
    append_new_files(spark, base, lake, [1])
    with monkeypatch.context() as patched:
        patched.setattr(sys.modules["tripline.plans.refresh"], "remember_loads", lambda *_: (_ for _ in ()).throw(SystemExit))
        with pytest.raises(SystemExit):
            append_new_files(spark, base, lake)
    assert counts(append_new_files(spark, base, lake)) == [(2023, 1, 2), (2023, 2, 1), (2023, 3, 2)]


def test_gold_from_sums(spark):
    silver = Standin.of(spark, "/root/testdata/sf0.01").silver()
    sums = sums_by_month_and_hour(silver)
    assert sums.count() <= 24 * 5
    months = merged_mean(sums, ["pickup_year", "pickup_month"], "total_amount")
    assert sorted(map(tuple, months.collect())) == sorted(map(tuple, avg_total_amount_by_month(silver).collect()))
    found = merged_count_by_month_hour(sums).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, trip_count_by_month_hour(silver).collect()))


def test_sums_of_nothing(spark):
    silver = Standin.of(spark, "/root/testdata/sf0.001").silver()
    odd = silver.limit(3).withColumn("total_amount", F.lit(None).cast("double"))
    assert merged_mean(sums_by_month_and_hour(odd), [], "total_amount").collect() == [(None, 3)]
    assert sums_by_month_and_hour(silver.limit(0)).count() == 0


def test_gold_of_touched_months_reads_no_other_month(spark, base, lake):  # noqa: F811
    build(spark, base, lake)
    before = sorted(map(tuple, seen_by(spark, lake, "gold_parts").collect()))
    forget_sums(spark, lake, {(2023, 2)})
    assert seen_by(spark, lake, "gold_parts").select("pickup_month").distinct().count() == 2
    for file in seen_by(spark, lake, "silver").inputFiles():
        if "pickup_month=2" not in file:  # what reads these files fails
            with open(file.removeprefix("file://").replace("%20", " ").replace("%27", "'"), "wb") as broken:
                broken.write(b"broken")
    refresh_gold(spark, lake, 2023, 3)
    assert sorted(map(tuple, seen_by(spark, lake, "gold_parts").collect())) == before
    assert len(seen_by(spark, lake, "gold_monthly").collect()) == 3


def test_a_rebuilt_silver_has_no_old_sums(spark, base, lake):  # noqa: F811
    build(spark, base, lake)
    create_silver(spark, lake=lake)
    assert seen_by(spark, lake, "gold_parts").count() == 0
    refresh_gold(spark, lake, 2023, 3)
    same_as_rebuilt(spark, lake)

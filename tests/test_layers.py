from __future__ import annotations

from datetime import date
from pathlib import Path
from uuid import uuid4

import pyarrow.parquet as pq
import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tests.rows import raw_rows
from tests.test_silver import trip
from tripline.contract import (
    DROPOFF,
    GOLD_TRIP_COLUMNS,
    PICKUP,
    RAW_PARTITIONS,
    Lakehouse,
    Period,
    landed_path,
)
from tripline.operators import QualityError, avg_total_amount_by_month
from tripline.plans import (
    answer_avg_passenger_count_by_hour,
    answer_avg_total_amount_by_month,
    create_all,
    create_gold,
    create_raw,
    create_silver,
    first_trips,
    layer_tables,
    replace_months,
    write_table,
)
from tripline.plans import tables
from tripline.plans.registry import queries
from tripline.plans.standin import Standin
from tripline.plans.tables import seen_by
from tripline.sources import read_landing
from tripline.sources.local import side_by_side


@pytest.fixture
def lake(tmp_path):
    return Lakehouse(database=f"test_{uuid4().hex}", location=str(tmp_path / "it's a lake"))


@pytest.fixture(scope="module")
def landed(spark):
    return Standin.of(spark, "/root/testdata/sf0.001").landing


def months_of(silver):
    return {(row.pickup_year, row.pickup_month): row["count"]
            for row in silver.groupBy("pickup_year", "pickup_month").count().collect()}


def without_load_times(df):
    return sorted(map(tuple, df.select(sorted(set(df.columns) - {"raw_loaded_at", "silver_loaded_at"})).collect()),
                  key=repr)


def land(spark, base, month, *trips):
    """Write one monthly file."""
    columns = ("VendorID", "passenger_count", "total_amount", PICKUP, DROPOFF)
    raw_rows(spark, *trips).select(*columns).write.parquet(landed_path(str(base), 2023, month))
    return str(base)


def test_whole_run(spark, landed, lake):
    built = create_all(spark, landed, lake=lake)
    assert set(built) == {"raw_df", "silver_df", "gold_trips_df", "monthly_avg_df", "may_hourly_passengers_df"}
    assert built["raw_df"].columns[-2:] == ["source_year", "source_month"]
    assert built["gold_trips_df"].columns == GOLD_TRIP_COLUMNS
    assert layer_tables(spark, lake).where("is_present").count() == 5
    assert months_of(built["silver_df"]) == {
        (2023, 1): 131, (2023, 2): 126, (2023, 3): 125, (2023, 4): 126, (2023, 5): 126}
    answer = answer_avg_total_amount_by_month(spark, lake).collect()
    assert [tuple(row) for row in answer][0] == (2023, 1, 51.81, 131)
    assert sum(row.trip_count for row in answer_avg_passenger_count_by_hour(spark, lake).collect()) == 126
    assert first_trips(spark, lake).count() == 100
    assert first_trips(spark, lake).columns == GOLD_TRIP_COLUMNS


def test_repeating_a_layer_changes_only_load_times(spark, landed, lake):
    create_raw(spark, landed, lake=lake)
    first = without_load_times(create_silver(spark, lake=lake))
    create_raw(spark, landed, lake=lake)
    assert without_load_times(create_silver(spark, lake=lake)) == first


def test_results_are_the_stored_tables(spark, landed, lake):
    create_raw(spark, landed, lake=lake)
    silver = create_silver(spark, lake=lake)
    assert silver.select("silver_loaded_at").distinct().count() == 1
    assert silver.select("silver_loaded_at").first() == silver.select("silver_loaded_at").first()


def test_append_stores_rows_twice_and_error_mode_refuses(spark, landed, lake):
    create_raw(spark, landed, lake=lake)
    assert create_raw(spark, landed, months=[2], mode="append", lake=lake).count() == 1171
    with pytest.raises(Exception, match="TABLE_OR_VIEW_ALREADY_EXISTS"):
        create_raw(spark, landed, months=[2], mode="error", lake=lake)
    assert create_raw(spark, landed, months=[2], mode="ignore", lake=lake).count() == 1171


def test_overwriting_partitions_leaves_the_others(spark, landed, lake):
    create_raw(spark, landed, months=[1, 2], mode="overwrite_partitions", lake=lake)
    before = spark.table(lake.table("raw")).where("source_month = 1").select("raw_loaded_at").first()
    raw = create_raw(spark, landed, months=["02", "03"], mode="overwrite_partitions", lake=lake)
    assert {row.source_month: row["count"] for row in raw.groupBy("source_month").count().collect()} == {
        1: 167, 2: 171, 3: 167}
    assert raw.where("source_month = 1").select("raw_loaded_at").first() == before
    assert raw.where("source_month = 2").select("raw_loaded_at").first() > before


def test_overwrite_replaces_the_schema(spark, lake):
    write_table(spark.range(3), lake, "gold_trips")
    stored = write_table(spark.range(2).select(F.col("id").cast("string").alias("other")), lake, "gold_trips")
    assert stored.dtypes == [("other", "string")] and stored.count() == 2


def test_a_build_leaves_the_sessions_own_writes_alone(spark, landed, lake):
    """While layers are built, another thread of the session overwrites a table of its own, as a whole."""
    own = f"{lake.database}.own"
    create_raw(spark, landed, lake=lake)
    rows = spark.range(6).selectExpr("id", "id % 3 AS part")
    rows.write.partitionBy("part").saveAsTable(own)
    before = spark.conf.getAll

    def build(turn):
        if turn:
            return create_raw(spark, landed, months=[2], mode="overwrite_partitions", lake=lake).count()
        for _ in range(4):
            rows.write.insertInto(own, overwrite=True)
            rows.where("part = 0").write.insertInto(own, overwrite=True)
            assert spark.table(own).count() == 2
        return 2

    assert side_by_side(spark, build, [1, 0]) == [1000, 2]
    assert spark.conf.getAll == before


def test_gold_trips_as_view_and_table(spark, landed, lake):
    create_raw(spark, landed, lake=lake)
    create_silver(spark, lake=lake)
    for kind in ("view", "view", "table", "table", "view"):
        trips = create_gold(spark, lake=lake, trips_as=kind)["gold_trips_df"]
        assert trips.columns == GOLD_TRIP_COLUMNS and trips.count() == 634
        assert layer_tables(spark, lake).where("is_present").count() == 5
    with pytest.raises(ValueError, match="trips_as"):
        create_gold(spark, lake=lake, trips_as="stream")


def test_the_period_is_that_of_the_load(spark, tmp_path, lake):
    base = str(tmp_path / "landing")
    columns = ("VendorID", "passenger_count", "total_amount", PICKUP, DROPOFF)

    def land_in(folder, year, month, *trips):
        raw_rows(spark, *trips).select(*columns).write.parquet(landed_path(folder, year, month))

    december = trip("2023-12-05 10:00:00", "2023-12-05 11:00:00")
    january = trip("2024-01-05 10:00:00", "2024-01-05 11:00:00")
    land_in(base, 2023, 12, december, january)
    land_in(base, 2024, 1, january)
    built = create_all(spark, base, months=[(2023, 12), (2024, 1)], lake=lake, hourly_month=(2024, 1))
    assert months_of(built["silver_df"]) == {(2023, 12): 1, (2024, 1): 2}
    land_in(base + "2", 2024, 1, january, january)
    assert months_of(replace_months(spark, base + "2", [1], 2024, lake=lake)) == {(2023, 12): 1, (2024, 1): 3}
    with pytest.raises(ValueError, match="built for"):
        replace_months(spark, base + "2", [1], 2024, lake=lake, period=Period())
    land_in(base + "2", 2024, 2, january)
    with pytest.raises(ValueError, match="not in the period"):
        replace_months(spark, base + "2", [2], 2024, lake=lake)
    with pytest.raises(QualityError, match="no row of raw is clean"):
        create_silver(spark, lake=lake, period=Period())


def test_other_period(spark, landed, lake):
    create_raw(spark, landed, lake=lake)
    silver = create_silver(spark, lake=lake, period=Period(date(2023, 2, 1), date(2023, 3, 1)))
    assert months_of(silver) == {(2023, 2): 126}


def test_checks_stop_the_run(spark, landed, lake):
    with pytest.raises(QualityError, match="months not landed.*6"):
        create_all(spark, landed, months=[5, 6], lake=lake)


def test_replacing_a_month_rebuilds_every_month_its_files_reach(spark, tmp_path, lake):
    """The old April file reaches into February and May, the new one into March; May loses its only trip."""
    march = trip("2023-03-05 10:00:00", "2023-03-05 11:00:00")
    april = trip("2023-04-05 10:00:00", "2023-04-05 11:00:00")
    february = trip("2023-02-05 10:00:00", "2023-02-05 11:00:00")
    may = trip("2023-05-05 10:00:00", "2023-05-05 11:00:00")
    january = trip("2023-01-05 10:00:00", "2023-01-05 11:00:00")
    old = land(spark, tmp_path / "old", 1, january)
    land(spark, tmp_path / "old", 2, february, march)
    land(spark, tmp_path / "old", 4, april, february, may)
    create_raw(spark, old, months=[1, 2, 4], lake=lake)
    silver = create_silver(spark, lake=lake, period=Period())
    assert months_of(silver) == {(2023, 1): 1, (2023, 2): 2, (2023, 3): 1, (2023, 4): 1, (2023, 5): 1}
    untouched = silver.where("pickup_month = 1").select("silver_loaded_at").first()

    new = land(spark, tmp_path / "new", 4, april, april, march, trip("2023-06-01 00:00:00", "2023-06-02 00:00:00"))
    silver = replace_months(spark, new, [4], lake=lake)
    assert months_of(silver) == {(2023, 1): 1, (2023, 2): 1, (2023, 3): 2, (2023, 4): 2}
    assert silver.where("pickup_month = 1").select("silver_loaded_at").first() == untouched
    assert len({file.rsplit("/", 1)[0] for file in spark.table(lake.table("silver")).inputFiles()}) == 4
    # The same rows as if everything were built anew.
    replaced = without_load_times(silver)
    assert without_load_times(create_silver(spark, lake=lake, period=Period())) == replaced


def test_replacing_can_be_repeated_after_it_was_cut_off(spark, tmp_path, lake):
    april = trip("2023-04-05 10:00:00", "2023-04-05 11:00:00")
    stray = trip("2023-02-05 10:00:00", "2023-02-05 11:00:00")
    create_raw(spark, land(spark, tmp_path / "old", 4, april, stray), months=[4], lake=lake)
    create_silver(spark, lake=lake)
    new = land(spark, tmp_path / "new", 4, april)
    create_raw(spark, new, months=[4], mode="overwrite_partitions", lake=lake)  # and then the run was lost
    assert months_of(replace_months(spark, new, [4], lake=lake)) == {(2023, 4): 1}


def test_replacing_with_a_file_without_valid_trips(spark, tmp_path, lake):
    april = trip("2023-04-05 10:00:00", "2023-04-05 11:00:00")
    create_raw(spark, land(spark, tmp_path / "old", 4, april), months=[4], lake=lake)
    create_silver(spark, lake=lake)
    new = land(spark, tmp_path / "new", 4, april | {"total_amount": None})
    assert months_of(replace_months(spark, new, [4], lake=lake)) == {}
    assert months_of(replace_months(spark, new, [4], lake=lake)) == {}


def test_december_ends_with_the_year(spark, tmp_path, lake):
    period = Period(date(2023, 12, 1), date(2024, 1, 1))
    december = trip("2023-12-31 23:59:59", "2024-01-01 00:10:00")
    base = land(spark, tmp_path / "old", 12, december)
    create_raw(spark, base, months=[12], lake=lake)
    create_silver(spark, lake=lake, period=period)
    assert months_of(replace_months(spark, base, [12], lake=lake, period=period)) == {(2023, 12): 1}


def test_monthly_counts_add_up(spark, landed, lake):
    create_raw(spark, landed, lake=lake)
    silver = create_silver(spark, lake=lake)
    assert sum(row.trip_count for row in avg_total_amount_by_month(silver).collect()) == silver.count()
    outside = (F.col(PICKUP) < F.lit(date(2023, 1, 1))) | (F.col(PICKUP) >= F.lit(date(2023, 6, 1)))
    assert silver.where(outside).count() == 0


def test_reloading_a_file_that_became_empty_empties_its_month(spark, tmp_path, lake):
    april = trip("2023-04-05 10:00:00", "2023-04-05 11:00:00")
    march = trip("2023-03-05 10:00:00", "2023-03-05 11:00:00")
    old = land(spark, tmp_path / "old", 3, march)
    land(spark, tmp_path / "old", 4, april, march)
    create_raw(spark, old, months=[3, 4], lake=lake)
    create_silver(spark, lake=lake)
    columns = ("VendorID", "passenger_count", "total_amount", PICKUP, DROPOFF)
    raw_rows(spark, april).select(*columns).limit(0).write.parquet(landed_path(str(tmp_path / "new"), 2023, 4))
    assert months_of(replace_months(spark, str(tmp_path / "new"), [4], lake=lake)) == {(2023, 3): 1}
    assert spark.table(lake.table("raw")).count() == 1


def test_database_in_the_warehouse(spark, landed):
    lake = Lakehouse(database=f"test_{uuid4().hex}")
    assert create_raw(spark, landed, months=[1], lake=lake).count() == 167


def test_stored_timestamps_have_statistics(spark, landed, lake):
    raw = create_raw(spark, landed, months=[1], lake=lake)
    file = pq.ParquetFile(raw.inputFiles()[0].removeprefix("file://").replace("%20", " ").replace("%27", "'"))
    pickup = file.metadata.row_group(0).column(file.schema_arrow.names.index(PICKUP))
    assert pickup.physical_type == "INT64" and pickup.statistics.has_min_max


def test_other_storage_format(spark, landed, tmp_path):
    lake = Lakehouse(database=f"test_{uuid4().hex}", location=str(tmp_path), storage="orc")
    create_raw(spark, landed, lake=lake)
    assert sum(months_of(create_silver(spark, lake=lake)).values()) == 634
    assert sum(months_of(replace_months(spark, landed, [5], lake=lake)).values()) == 634


def test_a_failed_write_of_partitions_leaves_the_old_rows(spark, landed, lake):
    create_raw(spark, landed, lake=lake)
    broken = read_landing(spark, landed).withColumn(
        "VendorID", F.when(F.col("VendorID") == 2, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("VendorID")))
    with pytest.raises(Exception, match="lost"):
        write_table(broken, lake, "raw", "overwrite_partitions", RAW_PARTITIONS)
    assert spark.table(lake.table("raw")).count() == 1000


def folders_of(lake, table):
    return [path for path in Path(lake.location).iterdir() if path.name.startswith(f"{table}-")]


@pytest.mark.parametrize("step", ["_point_at", "_create", "_take_name"])
def test_an_overwrite_that_is_cut_off_leaves_the_old_rows(spark, lake, monkeypatch, step):
    old, new = spark.range(3).withColumn("part", F.lit(1)), spark.range(3, 9).withColumn("part", F.lit(2))
    write_table(old, lake, "raw", partition_by=("part",))
    if step != "_point_at":
        new = new.withColumn("id", F.col("id").cast("string"))
    with monkeypatch.context() as patched:
        patched.setattr(tables, step, lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            write_table(new, lake, "raw", partition_by=("part",))
    assert sorted(map(tuple, spark.table(lake.table("raw")).collect())) == [(0, 1), (1, 1), (2, 1)]
    assert len(folders_of(lake, lake.raw)) == 1
    stored = write_table(new, lake, "raw", partition_by=("part",))
    assert stored.count() == 6 and stored.dtypes == new.dtypes
    assert {row.part for row in stored.collect()} == {2}  # no partition of the old table is left
    assert len(folders_of(lake, lake.raw)) == 1


def test_a_table_that_lost_its_name_gets_it_back(spark, lake, monkeypatch):
    """The driver is lost between the two renames that give a table of other columns its name."""
    write_table(spark.range(3), lake, "raw")
    sql, name = SparkSession.sql, lake.table("raw")

    def failing(session, text, *rest, **more):
        if text.endswith(f"__new RENAME TO {name}"):
            raise SystemExit
        return sql(session, text, *rest, **more)

    with monkeypatch.context() as patched:
        patched.setattr(SparkSession, "sql", failing)
        with pytest.raises(SystemExit):
            write_table(spark.range(2).select(F.lit("x").alias("other")), lake, "raw")
    assert not spark.catalog.tableExists(name)
    assert seen_by(spark, lake, "raw").count() == 3
    assert write_table(spark.range(2).select(F.lit("x").alias("other")), lake, "raw").columns == ["other"]


def test_a_table_can_be_overwritten_by_what_is_read_from_it(spark, lake):
    write_table(spark.range(5), lake, "raw")
    assert write_table(spark.table(lake.table("raw")).where("id > 2"), lake, "raw").count() == 2
    assert write_table(spark.range(0), lake, "raw", partition_by=()).count() == 0


def test_no_rows_make_a_table_with_its_partitions(spark, lake):
    stored = write_table(spark.range(0).withColumn("part", F.lit(1)), lake, "raw", partition_by=("part",))
    assert stored.count() == 0 and stored.columns == ["id", "part"]
    assert write_table(spark.range(4).withColumn("part", F.lit(1)), lake, "raw", "overwrite_partitions", ("part",)).count() == 4


def test_layers_built_by_several_threads(spark, landed, tmp_path):
    lakes = [Lakehouse(database=f"test_{uuid4().hex}", location=str(tmp_path / str(n))) for n in range(3)]
    def build(lake):
        create_raw(spark, landed, lake=lake)
        return create_raw(spark, landed, months=[2], mode="overwrite_partitions", lake=lake).count()

    assert side_by_side(spark, build, lakes) == [1000] * 3


def test_queries_leave_no_tables_or_folders_behind(spark):
    folder, names = "/root/testdata/sf0.001", ("raw_append_month", "incremental_month_replace", "landing_manifest")
    Standin.of(spark, folder).gold()
    root = Path(spark.conf.get("spark.checkpoint.dir"))

    def held():
        made = {path for path in root.iterdir() if path.name.split("-")[0] in ("lake", "landing", "manifest")}
        return made, spark.sql("SHOW DATABASES").count()

    before = held()
    for name in names:
        assert queries()[name](spark, folder).count() > 0
    assert held() == before

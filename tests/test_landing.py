from __future__ import annotations

from types import SimpleNamespace

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests.conftest import TESTDATA
from tripline.contract import landed_path
from tripline.plans.standin import Standin
from tripline.sources import (
    landing_inventory,
    landing_types,
    missing_landing_columns,
    missing_months,
    landed_parts,
    read_landing,
    read_month,
    schema_drift,
)
from tripline.sources import footers, landing
from tripline.sources.scratch import checkpoint_root, new_folder

RAW_TYPES = [
    ("VendorID", "int"), ("passenger_count", "double"), ("total_amount", "double"),
    ("tpep_pickup_datetime", "timestamp"), ("tpep_dropoff_datetime", "timestamp"),
    ("source_year", "int"), ("source_month", "int"), ("source_file", "string"), ("raw_loaded_at", "timestamp"),
]


@pytest.fixture(scope="module")
def landed(spark):
    return Standin.of(spark, str(TESTDATA / "sf0.01")).landing


def test_one_scan_over_drifted_files_fails_but_the_layered_read_does_not(spark, landed):
    files = [landed_path(landed, 2023, month) for month in range(1, 6)]
    with pytest.raises(Exception, match="PARQUET_COLUMN_DATA_TYPE_MISMATCH|FAILED_READ_FILE"):
        spark.read.parquet(*files).write.format("noop").mode("overwrite").save()
    with pytest.raises(Exception, match="CANNOT_MERGE_SCHEMAS"):
        spark.read.option("mergeSchema", "true").parquet(*files)
    raw = read_landing(spark, landed)
    assert raw.dtypes == RAW_TYPES
    assert raw.count() == 10000


def test_lineage(spark, landed):
    rows = read_landing(spark, landed + "/").groupBy("source_year", "source_month", "source_file").count().collect()
    assert sorted(tuple(row) for row in rows) == [
        (2023, month, landed_path(landed, 2023, month), count)
        for month, count in zip(range(1, 6), [1667, 1692, 1667, 1667, 3307])
    ]


def test_month_reads_only_its_file(spark, landed):
    february = read_month(spark, landed, 2023, 2)
    assert february.dtypes == RAW_TYPES
    assert february.select("source_month").distinct().collect() == [(2,)]
    assert [path.split("/")[-2] for path in february.inputFiles()] == ["yellow_tripdata_2023-02.parquet"]


def test_a_single_file_of_another_case_type_and_order(spark, tmp_path):
    plain = spark.sql("""SELECT 'x' AS year, '2023-04-01 10:00:00' AS TPEP_PICKUP_DATETIME,
        '2023-04-01T10:05:00' AS tpep_dropoff_datetime, '12.5' AS total_amount, 3000000000D AS vendorid,
        CAST(2 AS SMALLINT) AS passenger_count""")
    source = tmp_path / "parts"
    plain.coalesce(1).write.parquet(str(source))
    target = tmp_path / "landing" / "year=2023" / "month=04" / "yellow_tripdata_2023-04.parquet"
    target.parent.mkdir(parents=True)
    target.write_bytes(next(source.glob("*.parquet")).read_bytes())
    raw = read_landing(spark, str(tmp_path / "landing"), 2023, ["04"])
    assert raw.dtypes == RAW_TYPES
    row = raw.select("VendorID", "passenger_count", "total_amount", "source_year", "source_month",
                     F.col("tpep_dropoff_datetime").cast("string")).first()
    assert tuple(row) == (None, 2.0, 12.5, 2023, 4, "2023-04-01 10:05:00")


def test_missing_file_and_missing_column(spark, landed, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_landing(spark, landed, 2023, [5, 6])
    spark.read.parquet(landed_path(landed, 2023, 1)).drop("total_amount").write.parquet(
        landed_path(str(tmp_path), 2023, 1))
    with pytest.raises(ValueError, match="total_amount.*2023-01"):
        read_landing(spark, str(tmp_path), 2023, [1])
    lacking = missing_landing_columns(spark, str(tmp_path), 2023, [1]).select("year", "month", "column_name")
    assert lacking.distinct().collect() == [(2023, 1, "total_amount")]
    assert missing_landing_columns(spark, landed).count() == 0


@pytest.mark.parametrize("months", [[], [1, 1], ["01", 1], [0], [13]])
def test_months_are_checked(spark, landed, months):
    with pytest.raises(ValueError, match="month"):
        read_landing(spark, landed, 2023, months)


def test_inventory_and_missing_months(spark, landed):
    files = landing_inventory(spark, landed).collect()
    assert {(file.year, file.month) for file in files} == {(2023, month) for month in range(1, 6)}
    assert all(file.length > 0 for file in files)
    assert missing_months(spark, landed).count() == 0
    assert missing_months(spark, landed, 2023, range(1, 8)).sort("month").collect() == [(2023, 6), (2023, 7)]


def test_schema_drift(spark, landed):
    found = schema_drift(spark, landed).sort("column_name", "data_type").collect()
    assert [(row.column_name, row.data_type, row.file_count, row.months) for row in found] == [
        ("VendorID", "bigint", 1, [1]), ("VendorID", "int", 4, [2, 3, 4, 5]),
        ("passenger_count", "bigint", 4, [2, 3, 4, 5]), ("passenger_count", "double", 1, [1]),
    ]
    assert schema_drift(spark, landed, months=[2, 3]).count() == 0
    columns = len(spark.read.parquet(landed_path(landed, 2023, 1)).columns)
    assert landing_types(spark, landed, months=[1]).count() == columns * landed_parts(spark, landed, months=[1]).count()


def test_parts_of_a_month_that_differ(spark, landed, tmp_path):
    """The types of every part count, not those of one: no part is misread and no missing column goes unseen."""
    month, base = spark.read.parquet(landed_path(landed, 2023, 2)), str(tmp_path / "types")
    month.limit(5).write.parquet(landed_path(base, 2023, 2))
    month.limit(7).withColumn("total_amount", F.col("total_amount").cast("float")).write.mode("append").parquet(
        landed_path(base, 2023, 2))
    assert read_landing(spark, base, 2023, [2]).where("total_amount IS NOT NULL OR VendorID IS NULL").count() > 0
    assert read_landing(spark, base, 2023, [2]).count() == 12
    found = schema_drift(spark, base, 2023, [2]).collect()
    assert {(r.column_name, r.data_type) for r in found} == {("total_amount", "double"), ("total_amount", "float")}

    base = str(tmp_path / "columns")
    month.limit(5).write.parquet(landed_path(base, 2023, 2))
    month.limit(7).drop("total_amount").write.mode("append").parquet(landed_path(base, 2023, 2))
    with pytest.raises(ValueError, match=r"\['total_amount'\] in .*part-"):
        read_landing(spark, base, 2023, [2])
    lacking = missing_landing_columns(spark, base, 2023, [2]).collect()
    assert [(r.month, r.column_name) for r in lacking] == [(2, "total_amount")] and "part-" in lacking[0].path


def test_footers_not_written_by_spark(tmp_path):
    table = pa.table({"VendorID": pa.array([1], pa.uint32()), "at": pa.array([0], pa.timestamp("us")),
                      "utc": pa.array([0], pa.timestamp("us", "UTC")), "name": ["x"]})
    pq.write_table(table, tmp_path / "new.parquet")
    pq.write_table(table, tmp_path / "old.parquet", use_deprecated_int96_timestamps=True)
    new, old = (
        {c["name"]: c["type"] for c in footers.types_of(pq.ParquetFile(tmp_path / name))} for name in ("new.parquet", "old.parquet")
    )
    assert new == {"VendorID": "bigint", "at": "timestamp_ntz", "utc": "timestamp", "name": "string"}
    assert old["at"] == "timestamp"


@pytest.mark.parametrize("few", [0, 256])
def test_footers_that_only_spark_reads(spark, landed, monkeypatch, few):
    wanted = sorted(map(tuple, landing_types(spark, landed).collect()), key=repr)
    counts = sorted(map(tuple, read_landing(spark, landed).groupBy("source_month").count().collect()))
    monkeypatch.setattr(landing, "FEW", few)
    assert sorted(map(tuple, landing_types(spark, landed).collect()), key=repr) == wanted
    only_spark = f"viewfs://trips{landed}"
    found = sorted(map(tuple, landing_types(spark, only_spark).collect()), key=repr)
    assert [row[:2] + row[3:] for row in found] == [row[:2] + row[3:] for row in wanted]
    assert {row[2].split("/")[2] for row in found} == {"trips"}
    assert sorted(map(tuple, read_landing(spark, only_spark).groupBy("source_month").count().collect())) == counts


def test_a_broken_footer_is_an_error(spark, tmp_path):
    broken = tmp_path / "year=2023" / "month=01" / "yellow_tripdata_2023-01.parquet"
    broken.parent.mkdir(parents=True)
    broken.write_bytes(b"no parquet at all")
    assert footers.columns_of(str(broken))[1].startswith("ArrowInvalid")
    with pytest.raises(pa.ArrowInvalid):
        read_landing(spark, str(tmp_path), 2023, [1])


def test_a_thousand_files_need_no_job_each(spark, landed, tmp_path):
    """Scans and what comes to the driver depend on sets of types and months, not on the number of files."""
    base, part = str(tmp_path), spark.read.parquet(landed_path(landed, 2023, 2)).limit(2000)
    part.repartition(1000, "tpep_pickup_datetime", "total_amount").write.parquet(landed_path(base, 2023, 2))
    part.limit(3).coalesce(1).write.parquet(landed_path(base, 2023, 3))
    files = landed_parts(spark, base, months=[2, 3]).count()
    assert files > landing.FEW
    tracker = spark.sparkContext.statusTracker()
    for address in (base, f"viewfs://trips{base}"):
        spark.sparkContext.setJobGroup(f"footers of {address}", "reads footers")
        sets = landing._type_sets(spark, address, [(2023, 2), (2023, 3)])
        jobs = tracker.getJobIdsForGroup(f"footers of {address}")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert len(jobs) < 12
        assert [sorted(paths) for paths in sets.values()] == [[landed_path(address, 2023, 2), landed_path(address, 2023, 3)]]
    assert read_landing(spark, base, months=[2, 3]).count() == part.count() + 3


def test_files_of_two_years(spark, landed, tmp_path):
    base = str(tmp_path)
    for year, month in ((2023, 12), (2024, 1)):
        spark.read.parquet(landed_path(landed, 2023, 1)).limit(3).write.parquet(landed_path(base, year, month))
    found = read_landing(spark, base, months=[(2023, 12), (2024, "01")])
    rows = found.groupBy("source_year", "source_month", "source_file").count().collect()
    assert sorted(map(tuple, rows)) == [(y, m, landed_path(base, y, m), 3) for y, m in ((2023, 12), (2024, 1))]
    assert missing_months(spark, base, months=[(2023, 12), (2024, 2)]).collect() == [(2024, 2)]


def test_checkpoint_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_root(spark) == named
    assert new_folder(spark, "landing").startswith(f"{named}/landing-")


def test_a_cluster_must_name_its_checkpoint_folder():
    for master in ("yarn", "local-cluster[2,1,1024]"):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=context)
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            checkpoint_root(session)


def test_cast_losses(spark, tmp_path):
    """What casts to the contract's types null or change, by month and column."""
    big = 2**53 + 1
    rows = [(2.0, big, "1.5", "x"), (2.5, 3, "one", "2023-01-01 00:00:00"), (3e9, None, None, None), (None, 0, "", "2023-01-02"),
            (float("nan"), -1, "2", "2023")]
    month = spark.createDataFrame(rows, "VendorID double, passenger_count long, total_amount string, tpep_pickup_datetime string")
    month = month.withColumn("tpep_dropoff_datetime", F.lit(0).cast("timestamp"))
    month.write.parquet(landed_path(str(tmp_path), 2023, 1))
    found = {r.column_name: tuple(r)[3:] for r in landing.cast_losses(spark, str(tmp_path), months=[1]).collect()}
    assert found == {
        "VendorID": ("double", "int", 4, 2, 1),  # NaN and 3e9 do not fit, 2.5 loses its fraction
        "passenger_count": ("bigint", "double", 4, 0, 1),
        "total_amount": ("string", "double", 4, 2, 0),
        "tpep_pickup_datetime": ("string", "timestamp", 4, 1, 0),
    }
    typed = month.select(F.lit(1).alias("VendorID"), *(F.lit(1.0).alias(n) for n in ("passenger_count", "total_amount")),
                         *(F.lit(0).cast("timestamp").alias(n) for n in ("tpep_pickup_datetime", "tpep_dropoff_datetime")))
    typed.write.parquet(landed_path(str(tmp_path), 2023, 2))
    assert landing.cast_losses(spark, str(tmp_path), months=[2]).collect() == []

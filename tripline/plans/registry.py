"""The registered queries and, for each, the SQL that must give the same rows.

Landing queries read the monthly files, raw and silver queries read the stored table of the layer before them,
gold queries read silver. Load times and scratch folders differ from run to run and are left out.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripline.contract import (
    DROPOFF,
    GOLD_TRIP_COLUMNS,
    LINEAGE_TYPES,
    PICKUP,
    RAW_PARTITIONS,
    TRIP_COLUMNS,
    TRIP_TYPES,
    Lakehouse,
    landed_path,
)
from tripline.operators import gold, quality
from tripline.operators.silver import clean_trips
from tripline.plans import answers, refresh, tables
from tripline.plans.layers import create_raw, create_silver, replace_months
from tripline.plans.standin import ORACLE_TRIPS, Standin, write_landing
from tripline.sources import fetch, landing, relay
from tripline.sources.local import local_table
from tripline.sources.scratch import new_folder, remove

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def _registered(oracle: str) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        _QUERIES[query.__name__] = query
        _ORACLES[query.__name__] = _WITH + oracle
        return query

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


_WITH = f"""
WITH trips AS ({ORACLE_TRIPS}
), raw AS (
  SELECT CAST(VendorID AS INTEGER) AS VendorID, passenger_count, total_amount,
         tpep_pickup_datetime, tpep_dropoff_datetime,
         CAST(source_year AS INTEGER) AS source_year, CAST(source_month AS INTEGER) AS source_month,
         'year=2023/month=0' || source_month || '/yellow_tripdata_2023-0' || source_month || '.parquet' AS source_file
  FROM trips
), silver AS (
  SELECT *,
         CAST(tpep_pickup_datetime AS DATE) AS pickup_date,
         CAST(year(tpep_pickup_datetime) AS INTEGER) AS pickup_year,
         CAST(month(tpep_pickup_datetime) AS INTEGER) AS pickup_month,
         CAST(day(tpep_pickup_datetime) AS INTEGER) AS pickup_day,
         CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
         date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) / 60 AS trip_duration_minutes
  FROM raw
  WHERE VendorID IS NOT NULL AND passenger_count > 0 AND total_amount >= 0
    AND tpep_pickup_datetime >= TIMESTAMP '2023-01-01' AND tpep_pickup_datetime < TIMESTAMP '2023-06-01'
    AND tpep_dropoff_datetime > tpep_pickup_datetime
), by_month AS (
  SELECT pickup_year, pickup_month, round(avg(total_amount), 2) AS avg_total_amount, count(*) AS trip_count
  FROM silver GROUP BY pickup_year, pickup_month
), by_may_hour AS (
  SELECT pickup_hour, round(avg(passenger_count), 2) AS avg_passenger_count, count(*) AS trip_count
  FROM silver WHERE pickup_year = 2023 AND pickup_month = 5 GROUP BY pickup_hour
)
"""

_GOLD_COLUMNS = ", ".join(GOLD_TRIP_COLUMNS)


def _null_counts(table: str) -> str:
    counts = [f"count(*) FILTER ({name} IS NULL) AS {name}_nulls" for name in TRIP_COLUMNS]
    return f"SELECT {', '.join(counts)} FROM {table}"


def _violations(table: str) -> str:
    return f"""
    SELECT count(*) AS total_records,
           CAST(sum(CASE WHEN passenger_count <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS invalid_passenger_count,
           CAST(sum(CASE WHEN total_amount < 0 THEN 1 ELSE 0 END) AS BIGINT) AS negative_total_amount,
           CAST(sum(CASE WHEN tpep_dropoff_datetime <= tpep_pickup_datetime THEN 1 ELSE 0 END) AS BIGINT)
             AS invalid_trip_time,
           min(tpep_pickup_datetime) AS min_pickup_datetime, max(tpep_pickup_datetime) AS max_pickup_datetime
    FROM {table}"""


def _comparable(df: DataFrame) -> DataFrame:
    """Without load times, with zone-less timestamps and with source files relative to the landing base."""
    columns = []
    for field in df.schema:
        if field.name in ("raw_loaded_at", "silver_loaded_at"):
            continue
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif field.name == "source_file":
            column = F.regexp_extract(column, "year=.*$", 0)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def _finished(answer: DataFrame, *folders: str, lake: Lakehouse | None = None) -> DataFrame:
    """The few rows of an answer, after the tables and folders that were made for it are gone."""
    spark = answer.sparkSession
    rows = spark.createDataFrame(answer.toArrow(), answer.schema)
    if lake is not None:
        tables.drop_lake(spark, lake)
        folders = (*folders, lake.location)
    remove(spark, *folders)
    return rows


# Landing


@_registered("SELECT * FROM raw WHERE source_month = 1")
def landing_month_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(landing.read_month(spark, Standin.of(spark, sf_dir).landing, 2023, 1))


@_registered("SELECT count(*) AS record_count FROM raw")
def landing_record_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.record_count(landing.read_landing(spark, Standin.of(spark, sf_dir).landing))


@_registered('SELECT source_year, source_month, count(*) AS "count" FROM raw GROUP BY ALL')
def landing_count_by_source_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.count_by_source_month(landing.read_landing(spark, Standin.of(spark, sf_dir).landing))


@_registered("""
SELECT source_year, source_month, count(*) AS record_count, count(VendorID) AS vendors,
       sum(passenger_count) AS passengers, min(total_amount) AS least_amount, max(total_amount) AS most_amount
FROM raw GROUP BY source_year, source_month""")
def raw_union_with_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values from files of different types meet in one table without loss."""
    trips = landing.read_landing(spark, Standin.of(spark, sf_dir).landing)
    return trips.groupBy(*RAW_PARTITIONS).agg(
        F.count(F.lit(1)).alias("record_count"),
        F.count("VendorID").alias("vendors"),
        F.sum("passenger_count").alias("passengers"),
        F.min("total_amount").alias("least_amount"),
        F.max("total_amount").alias("most_amount"),
    )


@_registered("""
, types AS (
  SELECT unnest(['VendorID', 'VendorID', 'passenger_count', 'passenger_count']) AS column_name,
         unnest(['bigint', 'int', 'double', 'bigint']) AS data_type,
         unnest([TRUE, FALSE, TRUE, FALSE]) AS january)
SELECT column_name, data_type, count(DISTINCT source_month) AS file_count, count(*) AS record_count
FROM types JOIN raw ON january = (source_month = 1) GROUP BY column_name, data_type""")
def landing_schema_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns whose type differs between files, with the files and rows that have each type."""
    base = Standin.of(spark, sf_dir).landing
    drift = landing.schema_drift(spark, base)
    rows = landing.read_landing(spark, base).groupBy("source_month").agg(F.count(F.lit(1)).alias("rows"))
    return (
        drift.select("column_name", "data_type", "file_count", F.explode("months").alias("source_month"))
        .join(rows, "source_month")
        .groupBy("column_name", "data_type", "file_count")
        .agg(F.sum("rows").alias("record_count"))
    )


@_registered("""
SELECT CAST(2023 AS INTEGER) AS year, CAST(m AS INTEGER) AS month, count(source_month) > 0 AS is_landed,
       count(source_month) AS record_count
FROM range(1, 7) AS expected(m) LEFT JOIN raw ON source_month = m GROUP BY m""")
def landing_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completeness: which of the months January to June have files, and how many rows those hold."""
    base = Standin.of(spark, sf_dir).landing
    landed = landing.landing_inventory(spark, base).groupBy("year", "month").agg(F.sum("length").alias("bytes"))
    rows = (
        landing.read_landing(spark, base)
        .groupBy(F.col("source_year").alias("year"), F.col("source_month").alias("month"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return (
        landing.expected_months(spark, 2023, range(1, 7))
        .join(landed, ["year", "month"], "left")
        .join(rows, ["year", "month"], "left")
        .select(
            "year",
            "month",
            F.coalesce(F.col("bytes") > 0, F.lit(False)).alias("is_landed"),
            F.coalesce("rows", F.lit(0).cast("bigint")).alias("record_count"),
        )
    )


_THREE_RUNS = """
SELECT CAST(2023 AS INTEGER) AS year, CAST(m AS INTEGER) AS month,
       CASE WHEN count(source_month) > 0 THEN 2 ELSE 0 END::BIGINT AS fetched,
       CASE WHEN count(source_month) > 0 THEN 1 ELSE 0 END::BIGINT AS skipped,
       CASE WHEN count(source_month) > 0 THEN 0 ELSE 3 END::BIGINT AS failed,
       CASE WHEN count(source_month) > 0 THEN 'success' ELSE 'failed' END AS last_status,
       count(source_month) AS record_count
FROM range(1, 7) AS expected(m) LEFT JOIN raw ON source_month = m GROUP BY m"""


def _three_runs(spark: SparkSession, published: str, base: str, land) -> DataFrame:
    """Three runs over January to June, of which June is not published: fetch, run again, overwrite.

    The rows counted at the end are read from the fetched copies. The last run's attempts are added to the manifest
    twice, as a run does that is repeated after a failure; they count once.
    """
    history = new_folder(spark, "manifest")
    # The stand-in's files take the publisher's place, in the layout they are written in.
    files = fetch.landing_files(spark, published, base, 2023, range(1, 7)).withColumn(
        "source_url", F.replace("landing_path", F.lit(base), F.lit(published))
    )
    for overwrite in (False, False, True):
        attempts = land(files, overwrite)
        run = fetch.append_manifest(attempts, history)
    fetch.append_manifest(attempts, history, run)
    manifest = fetch.read_manifest(spark, history)
    outcome = F.substring_index("status", ":", 1)
    attempts = manifest.groupBy("year", "month").agg(
        F.count_if(outcome == "success").alias("fetched"),
        F.count_if(outcome == "skipped_already_exists").alias("skipped"),
        F.count_if(outcome == "failed").alias("failed"),
    )
    last = fetch.manifest_latest(manifest).select("year", "month", outcome.alias("last_status"))
    rows = (
        landing.read_landing(spark, base)
        .groupBy(F.col("source_year").alias("year"), F.col("source_month").alias("month"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    answer = (
        attempts.join(last, ["year", "month"])
        .join(rows, ["year", "month"], "left")
        .withColumn("record_count", F.coalesce("rows", F.lit(0).cast("bigint")))
        .drop("rows")
    )
    return _finished(answer, base, history)


@_registered(_THREE_RUNS)
def landing_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files are copied byte by byte."""
    return _three_runs(spark, Standin.of(spark, sf_dir).landing, new_folder(spark, "landing"), fetch.land_files)


@_registered(_THREE_RUNS)
def landing_manifest_by_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files go through Spark's readers and writers, as into storage that only Spark opens."""
    return _three_runs(spark, Standin.of(spark, sf_dir).landing, new_folder(spark, "landing"), relay.relay_files)


@_registered("""
SELECT CAST(2023 AS INTEGER) AS year, CAST(m AS INTEGER) AS month
FROM range(5, 8) AS expected(m) LEFT JOIN raw ON source_month = m GROUP BY m HAVING count(source_month) = 0""")
def landing_failed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The months from May to July whose last attempt did not fetch a file: those that are not published."""
    published, base = Standin.of(spark, sf_dir).landing, new_folder(spark, "landing")
    files = fetch.landing_files(spark, published, base, 2023, range(5, 8)).withColumn(
        "source_url", F.replace("landing_path", F.lit(base), F.lit(published))
    )
    return _finished(fetch.failed_files(fetch.land_files(files)).select("year", "month"), base)


@_registered("""
SELECT CAST(2023 AS INTEGER) AS year, CAST(source_month AS INTEGER) AS month,
       'https://data.example.org/trips/yellow_tripdata_2023-0' || source_month || '.parquet' AS source_url,
       count(*) AS record_count
FROM raw GROUP BY source_month""")
def landing_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each landed month is published, and how many rows it has."""
    base = Standin.of(spark, sf_dir).landing
    files = fetch.landing_files(spark, "https://data.example.org/trips/", base, 2023)
    counts = landing.read_landing(spark, base).groupBy(
        F.col("source_year").alias("year"), F.col("source_month").alias("month")
    ).agg(F.count(F.lit(1)).alias("record_count"))
    return files.drop("landing_path").join(counts, ["year", "month"])


@_registered("""
SELECT source_month, count(*) AS record_count, count(VendorID) AS vendors, sum(passenger_count) AS passengers,
       CAST(2 AS BIGINT) AS part_types
FROM raw WHERE source_month = 1 GROUP BY source_month""")
def landing_folder_of_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month that is a folder of parts whose types differ: no row and no value is lost."""
    base = new_folder(spark, "landing")
    trips = Standin.of(spark, sf_dir).trips.where("source_month = 1").drop("source_year", "source_month")
    odd = F.hash(PICKUP) % 2 == 0
    for some, kind in ((odd, "bigint"), (~odd | odd.isNull(), "int")):
        part = trips.where(some).withColumn("VendorID", F.col("VendorID").cast(kind))
        part.write.mode("append").parquet(landed_path(base, 2023, 1))
    drift = landing.schema_drift(spark, base, 2023, [1])
    counts = landing.read_landing(spark, base, 2023, [1]).groupBy("source_month").agg(
        F.count(F.lit(1)).alias("record_count"), F.count("VendorID").alias("vendors"),
        F.sum("passenger_count").alias("passengers"),
    )
    return _finished(counts.join(drift.agg(F.count(F.lit(1)).alias("part_types"))), base)


@_registered("""
SELECT CAST(2023 AS INTEGER) AS year, CAST(6 AS INTEGER) AS month, 'file' AS lacks
UNION ALL
SELECT DISTINCT CAST(2023 AS INTEGER), CAST(source_month AS INTEGER), 'total_amount' FROM raw WHERE source_month = 2""")
def landing_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a landing area lacks in which June is not landed and February has no amounts."""
    base, trips = new_folder(spark, "landing"), Standin.of(spark, sf_dir).trips
    write_landing(trips, base, [1, 3, 4, 5])
    write_landing(trips.drop("total_amount"), base, [2])
    months = landing.missing_months(spark, base, 2023, range(1, 7)).withColumn("lacks", F.lit("file"))
    columns = landing.missing_landing_columns(spark, base).select("year", "month", F.col("column_name").alias("lacks"))
    return _finished(months.union(columns.distinct()), base)


@_registered("""
SELECT CAST(2023 AS INTEGER) AS year, CAST(source_month AS INTEGER) AS month, 'VendorID' AS column_name,
       CASE source_month WHEN 1 THEN 'double' WHEN 2 THEN 'bigint' ELSE 'string' END AS data_type, 'int' AS stored_as,
       CASE source_month WHEN 1 THEN count(total_amount) ELSE count(VendorID) END AS value_count,
       CASE source_month WHEN 1 THEN 0 WHEN 2 THEN count(VendorID)
            ELSE count(*) FILTER (VendorID IS NOT NULL AND passenger_count > 3) END AS nulled,
       CASE source_month WHEN 1 THEN count(*) FILTER (total_amount <> trunc(total_amount)) ELSE 0 END AS changed
FROM raw WHERE source_month <= 3 GROUP BY source_month
UNION ALL
SELECT 2023, CAST(source_month AS INTEGER), 'passenger_count', 'bigint', 'double', count(passenger_count), 0, 0
FROM raw WHERE source_month IN (2, 3) GROUP BY source_month
UNION ALL
SELECT 2023, CAST(source_month AS INTEGER), 'tpep_pickup_datetime', 'timestamp_ntz', 'timestamp', count(tpep_pickup_datetime), 0, 0
FROM raw WHERE source_month <= 3 GROUP BY source_month
UNION ALL
SELECT 2023, CAST(source_month AS INTEGER), 'tpep_dropoff_datetime', 'timestamp_ntz', 'timestamp', count(tpep_dropoff_datetime), 0, 0
FROM raw WHERE source_month <= 3 GROUP BY source_month""")
def landing_cast_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendors that are amounts in January, too large in February and partly no numbers in March."""
    base, trips = new_folder(spark, "landing"), Standin.of(spark, sf_dir).trips
    vendors = {
        1: F.col("total_amount"),
        2: F.col("VendorID").cast("bigint") * 3_000_000_000,
        3: F.when(F.col("VendorID").isNotNull() & (F.col("passenger_count") > 3), "x").otherwise(F.col("VendorID").cast("string")),
    }
    for month, vendor in vendors.items():
        rows = trips.where(F.col("source_month") == month).withColumn("VendorID", vendor)
        if month > 1:
            rows = rows.withColumn("passenger_count", F.col("passenger_count").cast("bigint"))
        rows.drop("source_year", "source_month").write.parquet(landed_path(base, 2023, month))
    return _finished(landing.cast_losses(spark, base, 2023, [1, 2, 3]), base)


# Raw


@_registered("SELECT * FROM raw")
def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(Standin.of(spark, sf_dir).raw())


@_registered("SELECT count(*) AS record_count FROM raw")
def raw_record_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.record_count(Standin.of(spark, sf_dir).raw())


@_registered('SELECT source_year, source_month, count(*) AS "count" FROM raw GROUP BY ALL')
def raw_count_by_source_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.count_by_source_month(Standin.of(spark, sf_dir).raw())


@_registered(_null_counts("raw"))
def raw_null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_profile(Standin.of(spark, sf_dir).raw())


@_registered(_violations("raw"))
def raw_quality_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(quality.violation_profile(Standin.of(spark, sf_dir).raw()))


def _written(spark: SparkSession, profile: quality.WriteProfile) -> DataFrame:
    counted = profile.nulls | profile.violations
    rows = spark.createDataFrame([tuple(counted.values())], ", ".join(
        f"{name} {'timestamp' if name.endswith('_datetime') else 'bigint'}" for name in counted
    ))
    return _comparable(rows)


@_registered(f"SELECT * FROM ({_null_counts('raw')}), ({_violations('raw')})")
def raw_profile_of_the_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both profiles of raw, counted by the job that writes it."""
    standin, profile = Standin.of(spark, sf_dir), quality.WriteProfile()
    lake = standin.new_lake()
    create_raw(spark, standin.landing, lake=lake, profile=profile)
    return _finished(_written(spark, profile), lake=lake)


@_registered(f"SELECT * FROM ({_null_counts('silver')}), ({_violations('silver')})")
def silver_profile_of_the_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both profiles of silver, counted by the job that writes it."""
    standin, profile = Standin.of(spark, sf_dir), quality.WriteProfile()
    lake = standin.new_lake()
    create_raw(spark, standin.landing, lake=lake)
    create_silver(spark, lake=lake, profile=profile)
    return _finished(_written(spark, profile), lake=lake)


_STORED_SCHEMAS = {
    "raw": [*((name, kind.simpleString()) for name, kind in (TRIP_TYPES | LINEAGE_TYPES).items())],
    "silver": [
        *((name, kind.simpleString()) for name, kind in (TRIP_TYPES | LINEAGE_TYPES).items()),
        ("pickup_date", "date"), ("pickup_year", "int"), ("pickup_month", "int"), ("pickup_day", "int"),
        ("pickup_hour", "int"), ("trip_duration_minutes", "double"), ("silver_loaded_at", "timestamp"),
    ],
}


@_registered(
    ", expected(layer, column_name, data_type) AS (VALUES "
    + ", ".join(f"('{layer}', '{name}', '{kind}')" for layer, fields in _STORED_SCHEMAS.items() for name, kind in fields)
    + """)
SELECT expected.*, CASE layer WHEN 'raw' THEN (SELECT count(*) FROM raw) ELSE (SELECT count(*) FROM silver) END AS record_count
FROM expected"""
)
def stored_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns and types that the stored layers have, and the rows behind them."""
    standin = Standin.of(spark, sf_dir)
    layers = {"raw": standin.raw(), "silver": standin.silver()}
    counts = [quality.record_count(df).select(F.lit(layer).alias("layer"), "record_count") for layer, df in layers.items()]
    fields = [(layer, *field) for layer, df in layers.items() for field in df.dtypes]
    return local_table(spark, "layer string, column_name string, data_type string", fields).join(
        reduce(DataFrame.unionByName, counts), "layer"
    )


_REJECTS = {
    "VendorID_present": "VendorID IS NULL",
    "passenger_count_present": "passenger_count IS NULL",
    "total_amount_present": "total_amount IS NULL",
    "tpep_pickup_datetime_present": "tpep_pickup_datetime IS NULL",
    "tpep_dropoff_datetime_present": "tpep_dropoff_datetime IS NULL",
    "pickup_not_before_period": "tpep_pickup_datetime IS NULL OR tpep_pickup_datetime < TIMESTAMP '2023-01-01'",
    "pickup_before_period_end": "tpep_pickup_datetime IS NULL OR tpep_pickup_datetime >= TIMESTAMP '2023-06-01'",
    "dropoff_after_pickup": "tpep_pickup_datetime IS NULL OR tpep_dropoff_datetime IS NULL"
    " OR tpep_dropoff_datetime <= tpep_pickup_datetime",
    "passenger_count_positive": "passenger_count IS NULL OR passenger_count <= 0",
    "total_amount_not_negative": "total_amount IS NULL OR total_amount < 0",
}


@_registered(
    " UNION ALL ".join(f"SELECT '{rule}' AS rule, count(*) AS row_count FROM raw WHERE {broken}"
                       for rule, broken in _REJECTS.items())
    + " UNION ALL SELECT 'kept', count(*) FROM silver"
)
def raw_reject_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.reject_profile(Standin.of(spark, sf_dir).raw())


@_registered(
    " UNION ALL ".join(f"SELECT '{name}' AS column_name, TRUE AS is_present, count(*) AS record_count,"
                       f" count({name}) AS value_count FROM raw" for name in TRIP_COLUMNS)
)
def required_columns_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.column_availability(Standin.of(spark, sf_dir).raw())


@_registered("""
SELECT source_year, source_month, count(*) * CASE WHEN source_month = 1 THEN 2 ELSE 1 END AS "count"
FROM raw GROUP BY source_year, source_month""")
def raw_append_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows have no key: appending January a second time stores it twice."""
    standin = Standin.of(spark, sf_dir)
    lake = standin.new_lake()
    create_raw(spark, standin.landing, lake=lake)
    counts = quality.count_by_source_month(create_raw(spark, standin.landing, months=[1], mode="append", lake=lake))
    return _finished(counts, lake=lake)


@_registered("SELECT CAST(source_month AS VARCHAR) AS month, count(*) AS record_count FROM raw GROUP BY source_month")
def raw_schema_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole-table overwrite with other columns and partitions: nothing of the old table is left."""
    standin = Standin.of(spark, sf_dir)
    lake = standin.new_lake()
    raw = create_raw(spark, standin.landing, lake=lake)
    counts = raw.groupBy(F.col("source_month").cast("string").alias("month")).agg(F.count(F.lit(1)).alias("record_count"))
    return _finished(tables.write_table(counts, lake, "raw"), lake=lake)


_RAW_COLUMNS = [*TRIP_COLUMNS, *RAW_PARTITIONS]


@_registered(
    f"SELECT {', '.join(_RAW_COLUMNS)} FROM raw"
    f" ORDER BY {', '.join(f'{name} NULLS FIRST' for name in _RAW_COLUMNS)} LIMIT 10"
)
def raw_trips_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 10 rows; ordered by all columns, so that they are always the same."""
    raw = Standin.of(spark, sf_dir).raw().select(*_RAW_COLUMNS)
    return _comparable(raw.orderBy(*_RAW_COLUMNS).limit(10))


# Silver


@_registered("SELECT * FROM silver")
def silver_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(clean_trips(Standin.of(spark, sf_dir).raw()))


@_registered("SELECT count(*) AS record_count FROM silver")
def silver_record_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.record_count(Standin.of(spark, sf_dir).silver())


@_registered('SELECT pickup_year, pickup_month, count(*) AS "count" FROM silver GROUP BY ALL')
def silver_count_by_pickup_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.count_by_pickup_month(Standin.of(spark, sf_dir).silver())


@_registered(_null_counts("silver"))
def silver_null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_profile(Standin.of(spark, sf_dir).silver())


@_registered(_violations("silver"))
def silver_quality_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(quality.violation_profile(Standin.of(spark, sf_dir).silver()))


@_registered("""
, republished AS (
  SELECT * REPLACE (CASE WHEN source_month = 5 THEN abs(total_amount) ELSE total_amount END AS total_amount)
  FROM raw)
SELECT CAST(year(tpep_pickup_datetime) AS INTEGER) AS pickup_year,
       CAST(month(tpep_pickup_datetime) AS INTEGER) AS pickup_month,
       round(avg(total_amount), 2) AS avg_total_amount, count(*) AS trip_count
FROM republished
WHERE VendorID IS NOT NULL AND passenger_count > 0 AND total_amount >= 0
  AND tpep_pickup_datetime >= TIMESTAMP '2023-01-01' AND tpep_pickup_datetime < TIMESTAMP '2023-06-01'
  AND tpep_dropoff_datetime > tpep_pickup_datetime
GROUP BY ALL""")
def incremental_month_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """May is published again with its negative amounts put right. Only months its file reaches are rebuilt."""
    standin = Standin.of(spark, sf_dir)
    lake = standin.new_lake()
    create_raw(spark, standin.landing, lake=lake)
    create_silver(spark, lake=lake)
    corrected = standin.trips.withColumn("total_amount", F.abs("total_amount"))
    base = write_landing(corrected, new_folder(spark, "landing"), months=[5])
    silver = replace_months(spark, base, [5], lake=lake)
    return _finished(gold.avg_total_amount_by_month(silver), base, lake=lake)


@_registered("""
, two_years AS (
  SELECT * FROM raw WHERE source_month IN (4, 5)
  UNION ALL BY NAME
  SELECT * REPLACE (tpep_pickup_datetime + to_months(12) AS tpep_pickup_datetime,
                    tpep_dropoff_datetime + to_months(12) AS tpep_dropoff_datetime,
                    abs(total_amount) AS total_amount)
  FROM raw WHERE source_month = 1)
SELECT CAST(year(tpep_pickup_datetime) AS INTEGER) AS pickup_year,
       CAST(month(tpep_pickup_datetime) AS INTEGER) AS pickup_month,
       round(avg(total_amount), 2) AS avg_total_amount, count(*) AS trip_count
FROM two_years
WHERE VendorID IS NOT NULL AND passenger_count > 0 AND total_amount >= 0
  AND tpep_pickup_datetime >= TIMESTAMP '2023-04-01' AND tpep_pickup_datetime < TIMESTAMP '2024-02-01'
  AND tpep_dropoff_datetime > tpep_pickup_datetime
GROUP BY ALL""")
def second_year_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """April and May 2023 and January 2024 are built together; then that January is published again."""
    standin, lake, base = Standin.of(spark, sf_dir), Standin.of(spark, sf_dir).new_lake(), new_folder(spark, "landing")
    year = F.expr("INTERVAL 12 MONTHS")
    later = standin.trips.withColumns({name: F.col(name) + year for name in (PICKUP, DROPOFF)})
    write_landing(standin.trips, base, [4, 5])
    write_landing(later, base, [1], 2024)
    months = [(2023, 4), (2023, 5), (2024, 1)]
    create_raw(spark, base, months=months, lake=lake)
    create_silver(spark, lake=lake)
    again = write_landing(later.withColumn("total_amount", F.abs("total_amount")), new_folder(spark, "landing"), [1], 2024)
    silver = replace_months(spark, again, [(2024, 1)], lake=lake)
    return _finished(gold.avg_total_amount_by_month(silver), base, again, lake=lake)


# What changed since the load

_EDITED_SQL = """
, edited AS (
  SELECT * REPLACE (CASE WHEN source_month = 5 THEN abs(total_amount) ELSE total_amount END AS total_amount)
  FROM raw WHERE source_month <> 4
), edited_silver AS (
  SELECT CAST(year(tpep_pickup_datetime) AS INTEGER) AS pickup_year, CAST(month(tpep_pickup_datetime) AS INTEGER) AS pickup_month,
         CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour, total_amount, passenger_count
  FROM edited
  WHERE VendorID IS NOT NULL AND passenger_count > 0 AND total_amount >= 0
    AND tpep_pickup_datetime >= TIMESTAMP '2023-01-01' AND tpep_pickup_datetime < TIMESTAMP '2023-06-01'
    AND tpep_dropoff_datetime > tpep_pickup_datetime
)"""


def _edited(spark: SparkSession, sf_dir: str, first=(1, 2, 4, 5)) -> tuple[str, Lakehouse]:
    """A landing area that a lake knows in an earlier state: since then March has come, April has gone, and May is
    published again with its negative amounts put right. Returns its base and the lake, which has nothing but the loads."""
    standin = Standin.of(spark, sf_dir)
    lake, base = standin.new_lake(), new_folder(spark, "landing")
    write_landing(standin.trips, base, first)
    refresh.remember_loads(refresh.listed_files(spark, base), lake)
    return base, lake


def _edit(spark: SparkSession, sf_dir: str, base: str) -> None:
    trips = Standin.of(spark, sf_dir).trips
    remove(spark, landed_path(base, 2023, 4), landed_path(base, 2023, 5))
    write_landing(trips.withColumn("total_amount", F.abs("total_amount")), base, [5])


@_registered("""
SELECT CAST(2023 AS INTEGER) AS year, CAST(source_month AS INTEGER) AS month,
       CASE source_month WHEN 3 THEN 'new' WHEN 4 THEN 'vanished' ELSE 'changed' END AS change,
       CASE WHEN source_month = 4 THEN 0 ELSE count(*) END AS record_count
FROM raw WHERE source_month IN (3, 4, 5) GROUP BY source_month""")
def landing_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months that came, went or changed since the last load, and how many rows they have now."""
    base, lake = _edited(spark, sf_dir)
    _edit(spark, sf_dir, base)
    write_landing(Standin.of(spark, sf_dir).trips, base, [3])
    rows = landing.read_landing(spark, base, months=[1, 2, 3, 5]).groupBy(
        F.col("source_year").alias("year"), F.col("source_month").alias("month")
    ).agg(F.count(F.lit(1)).alias("rows"))
    found = refresh.landing_changes(spark, base, lake).join(rows, ["year", "month"], "left")
    found = found.withColumn("record_count", F.coalesce("rows", F.lit(0).cast("bigint"))).drop("rows")
    return _finished(found, base, lake=lake)


def _refreshed(spark: SparkSession, sf_dir: str) -> tuple[str, Lakehouse]:
    """A lake of January to May after April has gone and May has changed, brought up to date by what changed alone."""
    base, lake = _edited(spark, sf_dir, (1, 2, 3, 4, 5))
    create_raw(spark, base, lake=lake)
    create_silver(spark, lake=lake)
    refresh.refresh_gold(spark, lake)
    _edit(spark, sf_dir, base)
    refresh.refresh_lake(spark, base, lake)
    return base, lake


@_registered(f"""{_EDITED_SQL}
SELECT pickup_year, pickup_month, round(avg(total_amount), 2) AS avg_total_amount, count(*) AS trip_count
FROM edited_silver GROUP BY pickup_year, pickup_month""")
def refreshed_avg_total_amount_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold after a refresh, from sums of which only the touched months were made again."""
    base, lake = _refreshed(spark, sf_dir)
    return _finished(spark.table(lake.table("gold_monthly")), base, lake=lake)


@_registered(f"""{_EDITED_SQL}
SELECT pickup_year, pickup_month, pickup_hour, count(*) AS trip_count FROM edited_silver GROUP BY ALL""")
def refreshed_trip_count_by_month_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, lake = _refreshed(spark, sf_dir)
    return _finished(gold.merged_count_by_month_hour(spark.table(lake.table("gold_parts"))), base, lake=lake)


@_registered("""
SELECT pickup_hour, round(avg(passenger_count), 2) AS avg_passenger_count, count(*) AS trip_count
FROM silver WHERE pickup_year = 2023 AND pickup_month = 5 GROUP BY pickup_hour""")
def gold_hourly_from_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly question from sums by month and hour."""
    sums = gold.sums_by_month_and_hour(Standin.of(spark, sf_dir).silver())
    return gold.merged_mean(sums.where("pickup_year = 2023 AND pickup_month = 5"), ["pickup_hour"], "passenger_count")


@_registered('SELECT source_year, source_month, count(*) AS "count" FROM raw GROUP BY ALL')
def raw_append_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appending what is not loaded yet, again and again: every row is there once."""
    standin = Standin.of(spark, sf_dir)
    lake = standin.new_lake()
    refresh.append_new_files(spark, standin.landing, lake, [1, 2])
    refresh.append_new_files(spark, standin.landing, lake, [1])
    refresh.append_new_files(spark, standin.landing, lake)
    raw = refresh.append_new_files(spark, standin.landing, lake)
    return _finished(quality.count_by_source_month(raw), lake=lake)


# Gold


@_registered("SELECT pickup_year, pickup_month, pickup_hour, count(*) AS trip_count FROM silver GROUP BY ALL")
def trip_count_by_month_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.trip_count_by_month_hour(Standin.of(spark, sf_dir).silver())


@_registered(f"SELECT {_GOLD_COLUMNS} FROM silver")
def gold_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(gold.trip_facts(Standin.of(spark, sf_dir).silver()))


@_registered(f"SELECT {_GOLD_COLUMNS} FROM silver ORDER BY {_GOLD_COLUMNS} LIMIT 100")
def gold_trips_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 100 trips; ordered by all columns, so that they are always the same."""
    lake = Standin.of(spark, sf_dir).gold()
    return _comparable(spark.table(lake.table("gold_trips")).orderBy(*GOLD_TRIP_COLUMNS).limit(100))


@_registered("SELECT least(count(*), 100) AS rows_shown, least(count(*), 100) AS rows_known FROM silver")
def gold_first_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The preview shows a hundred rows, and all are trips of the table."""
    lake = Standin.of(spark, sf_dir).gold()
    shown = answers.first_trips(spark, lake)
    known = spark.table(lake.table("gold_trips")).select(*GOLD_TRIP_COLUMNS).distinct()
    found = shown.join(known.withColumn("known", F.lit(1)), GOLD_TRIP_COLUMNS, "left")
    return found.agg(F.count(F.lit(1)).alias("rows_shown"), F.count("known").alias("rows_known"))


@_registered("SELECT * FROM by_month")
def gold_avg_total_amount_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.avg_total_amount_by_month(Standin.of(spark, sf_dir).silver())


@_registered("SELECT * FROM by_may_hour")
def gold_avg_passenger_count_may_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.avg_passenger_count_by_hour(Standin.of(spark, sf_dir).silver())


@_registered("SELECT * FROM by_month ORDER BY pickup_year, pickup_month")
def answer_avg_total_amount_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answers.answer_avg_total_amount_by_month(spark, Standin.of(spark, sf_dir).gold())


@_registered("SELECT * FROM by_may_hour ORDER BY pickup_hour")
def answer_avg_passenger_count_may_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answers.answer_avg_passenger_count_by_hour(spark, Standin.of(spark, sf_dir).gold())


_LAYERS = {
    "raw_yellow_taxi_trips": "raw",
    "silver_yellow_taxi_trips": "silver",
    "gold_yellow_taxi_trips": "silver",
    "gold_avg_total_amount_by_month": "by_month",
    "gold_avg_passenger_count_may_by_hour": "by_may_hour",
}


@_registered(
    " UNION ALL ".join(f"SELECT '{name}' AS table_name, TRUE AS is_present, count(*) AS record_count FROM {rows}"
                       for name, rows in _LAYERS.items())
)
def layer_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables are in the catalog and can be read."""
    lake = Standin.of(spark, sf_dir).gold()
    counts = [
        quality.record_count(spark.table(f"{lake.database}.{name}")).withColumn("table_name", F.lit(name))
        for name in lake.table_names()
    ]
    return tables.layer_tables(spark, lake).join(reduce(DataFrame.unionByName, counts), "table_name")

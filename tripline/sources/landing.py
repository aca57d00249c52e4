"""The landing area: monthly Parquet files whose physical types may differ from month to month."""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripline.contract import (
    DEFAULT_MONTHS,
    DEFAULT_YEAR,
    TRIP_COLUMNS,
    TRIP_TYPES,
    landed_path,
    year_months,
)
from tripline.functions import typed
from tripline.sources import footers
from tripline.sources.filesystem import DriverFile
from tripline.sources.local import local_table, side_by_side

# Executors get the functions themselves, so that the package need not be installed there.
cloudpickle.register_pickle_by_value(footers)


# Footers that the driver reads itself; those of more files are read in tasks.
FEW = 256

_MONTH = re.compile(r"/year=(\d+)/month=(\d+)/")


def landed_parts(spark: SparkSession, base: str, year: int = DEFAULT_YEAR, months=DEFAULT_MONTHS) -> DataFrame:
    """Every file of the months: ``path``, ``year``, ``month``. A month is one file or a folder of parts; one without
    raises."""
    return _files(spark, base, year_months(year, months)).select("path", _folder("year"), _folder("month"))


def _files(spark: SparkSession, base: str, asked: list[tuple[int, int]]) -> DataFrame:
    paths = [landed_path(base, *month) for month in asked]
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)


def _listed(spark: SparkSession, base: str, asked: list[tuple[int, int]]) -> list[str]:
    """The paths that Spark has listed, written as its readers write them."""
    return [re.sub("^file:///", "file:/", unquote(path)) for path in _files(spark, base, asked).inputFiles()]


def landing_types(
    spark: SparkSession, base: str, year: int = DEFAULT_YEAR, months=DEFAULT_MONTHS
) -> DataFrame:
    """One row per file and column, with the column's physical type, read from every file's footer.

    The footers of many files are read in tasks. Those that tasks cannot open, because only Spark reads their storage,
    are read by the driver through Spark's file system layer: a few kilobytes each, many at a time, without a job.
    """
    return _part_types(spark, base, year_months(year, months)).select(
        F.col("year").alias("source_year"), F.col("month").alias("source_month"), "path", F.inline_outer("columns")
    ).withColumnsRenamed({"name": "column_name", "type": "data_type"})


def _part_types(spark: SparkSession, base: str, asked: list[tuple[int, int]]) -> DataFrame:
    """One row per file: ``path``, ``year``, ``month``, ``columns``."""
    listed = _listed(spark, base, asked)
    if len(listed) <= FEW:
        return _as_table(spark, part_columns(spark, listed))
    found = landed_parts(spark, base, months=asked).mapInArrow(footers.read, f"{_PART}, error string")
    unread = [row.path for row in found.where("columns IS NULL").select("path").collect()]
    read = found.where("columns IS NOT NULL").drop("error")
    return read.union(_as_table(spark, _through_spark(spark, unread))) if unread else read


_PART = "path string, year int, month int, columns array<struct<name string, type string>>"


def part_columns(spark: SparkSession, paths: list[str]) -> dict[str, list[dict[str, str]]]:
    """The columns of a few files by path, read by the driver."""
    found = dict(zip(paths, side_by_side(spark, lambda path: footers.columns_of(path)[0], paths)))
    return found | _through_spark(spark, [path for path, columns in found.items() if columns is None])


def _through_spark(spark: SparkSession, paths: list[str]) -> dict[str, list[dict[str, str]]]:
    def columns(path: str) -> list[dict[str, str]]:
        with DriverFile(spark, path) as file:
            return footers.types_of(pq.ParquetFile(pa.PythonFile(file, mode="r")))

    return dict(zip(paths, side_by_side(spark, columns, paths)))


def _as_table(spark: SparkSession, found: dict[str, list[dict[str, str]]]) -> DataFrame:
    rows = [(path, *map(int, _MONTH.search(path).groups()), columns) for path, columns in found.items()]
    return local_table(spark, _PART, rows)


def _required(columns: list[dict[str, str]]) -> tuple:
    """Names in lower case and types of the required columns that a file has."""
    wanted = set(map(str.lower, TRIP_COLUMNS))
    return tuple(sorted((c["name"].lower(), c["type"]) for c in columns if c["name"].lower() in wanted))


def _type_sets(spark: SparkSession, base: str, asked: list[tuple[int, int]]) -> dict[tuple, list[str]]:
    """What to read by set of types of the required columns: a month whose files agree as a whole, else its files.

    What comes to the driver of many files is a row per month and set of types, and the paths where a month disagrees.
    """
    listed = _listed(spark, base, asked)
    months: dict[tuple[int, int], dict[tuple, list[str]]] = {}

    def note(found: dict[str, list[dict[str, str]]]) -> None:
        for path, columns in found.items():
            own = months.setdefault(tuple(map(int, _MONTH.search(path).groups())), {})
            own.setdefault(_required(columns), []).append(path)

    if len(listed) <= FEW:
        note(part_columns(spark, listed))
    else:
        parts = landed_parts(spark, base, months=asked).mapInArrow(footers.read, f"{_PART}, error string")
        sets = parts.groupBy("year", "month", "columns").agg(F.collect_list("path").alias("paths"), F.first("error").alias("error"))
        alone = F.count(F.lit(1)).over(W.partitionBy("year", "month")) == 1
        unread = F.col("columns").isNull()
        for row in sets.withColumn("paths", F.when(unread | ~alone, F.col("paths"))).collect():
            if row.columns is None:
                note(_through_spark(spark, row.paths))
            else:
                own = months.setdefault((row.year, row.month), {})
                own.setdefault(_required([c.asDict() for c in row.columns]), []).extend(row.paths or [])
    found: dict[tuple, list[str]] = {}
    for month, sets in months.items():
        for types, paths in sets.items():
            found.setdefault(types, []).extend([landed_path(base, *month)] if len(sets) == 1 else paths)
    return found


def read_landing(
    spark: SparkSession, base: str, year: int = DEFAULT_YEAR, months=DEFAULT_MONTHS
) -> DataFrame:
    """All asked months in the contract's types, with their lineage.

    ``months`` are months of ``year`` or (year, month) pairs. Files that share their physical types are read by one
    scan, so the plan has as many scans as there are type sets, not as there are files. Year and month come from the
    folder names, so a filter on ``source_year`` or ``source_month`` leaves the other files unread. A file without a
    required column raises, and is named.
    """
    asked = year_months(year, months)
    scans = [_scan(spark, base, asked, dict(types), paths) for types, paths in _type_sets(spark, base, asked).items()]
    return reduce(DataFrame.unionByName, scans)


def _scan(spark: SparkSession, base: str, asked: list[tuple[int, int]], types: dict[str, str], paths: list[str]) -> DataFrame:
    """Files of one set of types, in the contract's types."""
    missing = [name for name in TRIP_COLUMNS if name.lower() not in types]
    if missing:
        raise ValueError(f"missing required columns {missing} in {', '.join(sorted(paths)[:10])}")
    columns = [f"`{name}` {types[name.lower()]}" for name in TRIP_COLUMNS]
    files = spark.read.option("basePath", base).schema(", ".join([*columns, "year int", "month int"])).parquet(*paths)
    # One constant per month: formatting the path for each row would take longer than reading the row.
    of_month = [F.when((F.col("year") == y) & (F.col("month") == m), landed_path(base, y, m)) for y, m in asked]
    return files.select(
        *typed(TRIP_TYPES),
        F.col("year").alias("source_year"),
        F.col("month").alias("source_month"),
        F.coalesce(*of_month).alias("source_file"),
        F.current_timestamp().alias("raw_loaded_at"),
    )


def read_month(spark: SparkSession, base: str, year: int, month: int) -> DataFrame:
    """One monthly file in the contract's types, with its lineage."""
    return read_landing(spark, base, year, [month])


def landing_inventory(spark: SparkSession, base: str) -> DataFrame:
    """Every Parquet file below ``base``: path, length, modification time, year and month. No content is read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(base)
    )

    return files.select("path", "length", "modificationTime", _folder("year"), _folder("month"))


def _folder(name: str) -> Column:
    """The number that a folder of the path gives."""
    digits = F.regexp_extract("path", rf"/{name}=(\d+)/", 1)
    return F.when(digits != "", digits.cast("int")).alias(name)


def expected_months(spark: SparkSession, year: int = DEFAULT_YEAR, months=DEFAULT_MONTHS) -> DataFrame:
    """One row per month that should have been landed."""
    return local_table(spark, "year int, month int", year_months(year, months))


def missing_months(
    spark: SparkSession, base: str, year: int = DEFAULT_YEAR, months=DEFAULT_MONTHS
) -> DataFrame:
    """Expected months without any file in the landing area."""
    return expected_months(spark, year, months).join(
        landing_inventory(spark, base), ["year", "month"], "left_anti"
    )


def missing_landing_columns(
    spark: SparkSession, base: str, year: int = DEFAULT_YEAR, months=DEFAULT_MONTHS
) -> DataFrame:
    """Required columns that a file lacks, by part; upper and lower case are the same to a reader."""
    held = landing_types(spark, base, year, months).groupBy("source_year", "source_month", "path").agg(
        F.collect_set(F.lower("column_name")).alias("held")
    )
    required = F.explode(F.array(*map(F.lit, TRIP_COLUMNS))).alias("column_name")
    wanted = held.select(F.col("source_year").alias("year"), F.col("source_month").alias("month"), "path", "held", required)
    return wanted.where(~F.array_contains("held", F.lower("column_name"))).select("year", "month", "path", "column_name")


def schema_drift(
    spark: SparkSession, base: str, year: int = DEFAULT_YEAR, months=DEFAULT_MONTHS
) -> DataFrame:
    """The columns that not all files share in the same type: one row per column and type, with its files.

    ``part_count`` are the files, ``file_count`` and ``months`` the months that have the column so. A column of one
    type that is in every file has one group as large as the number of files; any smaller group belongs to a column
    that changed its type or is absent somewhere.
    """
    types = landing_types(spark, base, year, months)
    total = types.agg(F.count_distinct("path").alias("total"))
    month = F.struct("source_year", "source_month")
    found = types.where("column_name IS NOT NULL").groupBy("column_name", "data_type").agg(
        F.count_distinct("source_year", "source_month").alias("file_count"),
        F.count(F.lit(1)).alias("part_count"),
        F.sort_array(F.collect_set(month)).alias("found"),
    )
    drifted = found.join(total, F.col("part_count") < F.col("total"))
    return drifted.select(
        "column_name", "data_type", "file_count", "part_count", F.col("found.source_month").alias("months")
    )


def cast_losses(
    spark: SparkSession, base: str, year: int = DEFAULT_YEAR, months=DEFAULT_MONTHS
) -> DataFrame:
    """What bringing landing files to the contract's types costs: one row per month, required column and physical type
    that is not the contract's.

    ``value_count`` values there are; ``nulled`` ones do not fit and become NULL; ``changed`` ones become another value,
    which is told by casting them back: a fraction that is cut off, a whole number that a double does not hold. Text is
    only parsed, so none of it counts as changed. One scan per set of types and one small row per task and month.
    """
    asked = year_months(year, months)
    profiles = []
    for types, paths in _type_sets(spark, base, asked).items():
        types, wanted = dict(types), {name.lower(): (name, kind) for name, kind in TRIP_TYPES.items()}
        others = {name: kind for name, kind in types.items() if kind != wanted[name][1].simpleString()}
        if not others:
            continue
        fields = ", ".join(f"`{wanted[name][0]}` {kind}" for name, kind in others.items())
        rows = spark.read.option("basePath", base).schema(f"{fields}, year int, month int").parquet(*paths)
        measures = [F.array(*(_cast_loss(*wanted[name], kind) for name, kind in others.items())).alias("losses")]
        profiles.append(rows.groupBy("year", "month").agg(*measures).select("year", "month", F.inline("losses")))
    if not profiles:
        return local_table(spark, _LOSSES, [])
    return reduce(DataFrame.unionByName, profiles)


_LOSSES = (
    "year int, month int, column_name string, data_type string, stored_as string, value_count bigint, nulled bigint, changed bigint"
)


def _cast_loss(name: str, stored: T.DataType, kind: str) -> Column:
    value = F.col(name)
    cast = value.try_cast(stored)
    back = cast.try_cast(kind)
    other = F.lit(False) if kind == "string" else cast.isNotNull() & ~back.eqNullSafe(value)
    return F.struct(
        F.lit(name).alias("column_name"),
        F.lit(kind).alias("data_type"),
        F.lit(stored.simpleString()).alias("stored_as"),
        F.count(value).alias("value_count"),
        F.count_if(value.isNotNull() & cast.isNull()).alias("nulled"),
        F.count_if(other).alias("changed"),
    )

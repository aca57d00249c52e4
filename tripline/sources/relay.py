"""Land monthly files through Spark's own readers and writers, where tasks cannot open the landing area as a file system.

A month becomes a folder of Parquet parts, with the columns and physical types of its source. Each part is written front
to back by one task and committed by Spark, so no task writes at an offset; an empty ``_SUCCESS`` file comes last and
says that the month is whole. A folder without it is what a lost run left behind, and is landed again.
"""

from __future__ import annotations

import json
import re
from uuid import uuid4

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tripline.sources import footers, relay_web
from tripline.sources.fetch import MANIFEST_TYPES
from tripline.sources.filesystem import delete, exists, file_states, is_folder, rename, touch
from tripline.sources.landing import part_columns
from tripline.sources.local import local_table, side_by_side
from tripline.sources.transfer import utc_now

# Executors get the functions themselves, so that the package need not be installed there.
cloudpickle.register_pickle_by_value(relay_web)

MARKER = "_SUCCESS"


def relay_files(files: DataFrame, overwrite: bool = False) -> DataFrame:
    """Land the files of ``landing_files`` by their rows, and return their manifest rows.

    Source and target are any addresses that Spark opens, and sources may be web addresses that serve byte ranges: their
    row groups are read by tasks. Months are landed side by side, each by one job for each set of types among its parts.
    A month that is whole is kept unless ``overwrite``; then the new folder is written beside it and takes its place once
    it is whole. A failure is recorded in ``status`` and leaves an older month as it was. What the driver handles are one
    row a month and the footers of the sources.
    """
    spark = files.sparkSession
    months = [(row.year, row.month, row.source_url, row.landing_path) for row in files.collect()]

    def land(month: tuple) -> tuple:
        started = utc_now()
        try:
            status, size = _landed(spark, month[2], month[3], overwrite)
        except Exception as error:
            status, size = f"failed: {type(error).__name__}: {error}", None
        return (*month, status, size, started, utc_now())

    schema = ", ".join(f"{name} {kind.simpleString()}" for name, kind in MANIFEST_TYPES.items())
    return local_table(spark, schema, side_by_side(spark, land, months))


def is_whole(spark: SparkSession, path: str) -> bool:
    """Whether a month lies at ``path``: a file, or a folder with its marker."""
    return exists(spark, f"{path}/{MARKER}" if is_folder(spark, path) else path)


def _landed(spark: SparkSession, source: str, target: str, overwrite: bool) -> tuple[str, int | None]:
    if is_whole(spark, target) and not overwrite:
        return "skipped_already_exists", None
    folder, name = target.rsplit("/", 1)
    # What lies there, whole or left behind, goes only when the new folder can take its place.
    there = exists(spark, target)
    written = f"{folder}/.{name}.{uuid4().hex}" if there else target
    try:
        for part in _parts(spark, source):
            # Without Spark's own marker, which each of these jobs would set.
            part.write.mode("append").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(written)
        size = sum(state.length for state in file_states(spark, written))
        if there:
            _replaced(spark, written, target)
        touch(spark, f"{target}/{MARKER}")
    except Exception:
        delete(spark, written)
        raise
    return "success", size


def _replaced(spark: SparkSession, written: str, target: str) -> None:
    """The new folder takes the old one's place, which comes back if that fails."""
    previous = f"{written}.previous"
    rename(spark, target, previous)
    try:
        rename(spark, written, target)
    except Exception:
        rename(spark, previous, target)
        raise
    delete(spark, previous)


def _parts(spark: SparkSession, source: str) -> list[DataFrame]:
    """The rows of a source, one table for each set of types."""
    if re.match("https?:", source):
        file, web = relay_web.opened(source)
        schema = _schema(footers.types_of(file))
        groups = spark.range(file.num_row_groups, numPartitions=max(1, file.num_row_groups)).selectExpr("CAST(id AS INT) AS group")
        arrow = to_arrow_schema(schema)
        return [groups.mapInArrow(relay_web.row_groups(source, web.version, arrow), schema)]
    sets: dict[str, list[str]] = {}
    for path, columns in part_columns(spark, [state.path for state in file_states(spark, source)]).items():
        sets.setdefault(_schema(columns).json(), []).append(path)
    if not sets:
        raise FileNotFoundError(f"no files in {source}")
    return [spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(*paths) for schema, paths in sets.items()]


def _schema(columns: list[dict[str, str]]) -> StructType:
    return StructType.fromDDL(", ".join(f"`{c['name'].replace('`', '``')}` {c['type']}" for c in columns))

"""Fetch published monthly files into the landing area and keep a manifest of every attempt."""

from __future__ import annotations

from uuid import uuid4

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripline.contract import (
    DEFAULT_MONTHS,
    DEFAULT_YEAR,
    landed_path_column,
    published_url_column,
)
from tripline.sources import transfer
from tripline.sources.filesystem import children, delete, rename
from tripline.sources.landing import expected_months
from tripline.sources.scratch import checkpoint_root

# Executors get the functions themselves, so that the package need not be installed there.
cloudpickle.register_pickle_by_value(transfer)

# One row per attempt at a file. The two times are ISO-8601 text in UTC.
MANIFEST_TYPES: dict[str, T.DataType] = {
    "year": T.IntegerType(),
    "month": T.IntegerType(),
    "source_url": T.StringType(),
    "landing_path": T.StringType(),
    "status": T.StringType(),
    "file_size_bytes": T.LongType(),
    "ingestion_started_at": T.StringType(),
    "ingestion_finished_at": T.StringType(),
}

RANGE_BYTES = 256 << 20

_INSPECTED = (
    "started string, kept boolean, parts array<struct<name string, size bigint, seekable boolean, version string>>, error string"
)
_COPIED = "bytes bigint, error string"
_PUBLISHED = "status string, size bigint, finished string"


def landing_files(
    spark: SparkSession,
    published_base: str,
    landing_base: str,
    year: int = DEFAULT_YEAR,
    months=DEFAULT_MONTHS,
) -> DataFrame:
    """One row per monthly file: where it is published and where it belongs."""
    y, m = F.col("year"), F.col("month")
    return expected_months(spark, year, months).select(
        "year",
        "month",
        published_url_column(published_base, y, m).alias("source_url"),
        landed_path_column(landing_base, y, m).alias("landing_path"),
    )


def land_files(
    files: DataFrame, overwrite: bool = False, mount: tuple[str, str] = ("file:", ""), range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """Fetch the files of ``landing_files`` and return their manifest rows.

    The work is split by byte range, not by file: a file of any size is copied by many tasks, each writing its
    ranges into one hidden staging file that is renamed once it is whole. A monthly file may also be a folder of
    part files. A failure is recorded in ``status`` and leaves an older file as it was.

    ``mount`` turns a landing path into the path tasks write to, as a prefix and its replacement, for
    storage that Spark and the file system address differently. What is then not an absolute path, as the address
    of an object store that is not mounted, raises before anything is fetched: tasks would write it to folders of
    their own machines. There are as many copy tasks as there are ranges of ``range_bytes``.

    Each step is cut with ``checkpoint()``, so a lost executor never repeats a step that others built on.
    """
    spark = files.sparkSession
    checkpoint_root(spark)
    run = uuid4().hex
    inspect = F.udf(transfer.inspect, _INSPECTED, useArrow=False).asNondeterministic()
    copy_range = F.udf(transfer.copy_range, _COPIED, useArrow=False).asNondeterministic()
    publish = F.udf(transfer.publish, _PUBLISHED, useArrow=False).asNondeterministic()

    prefix, replacement = mount
    path = F.col("landing_path")
    written = F.when(
        path.startswith(prefix), F.concat(F.lit(replacement), F.substring(path, F.lit(len(prefix) + 1), F.length(path)))
    ).otherwise(path)
    folder, name = F.regexp_extract(written, r"^(.*/)", 1), F.substring_index(written, "/", -1)

    known = files.select("year", "month", "source_url", "landing_path", written.alias("target"),
                         F.concat(folder, F.lit("."), name, F.lit(f".{run}")).alias("staged"))
    astray = [row.target for row in known.where("NOT startswith(target, '/')").limit(3).collect()]
    if astray:
        raise ValueError(f"mount does not say where tasks reach {', '.join(astray)}")
    inspected = (
        known.repartition(max(1, known.count()))
        .withColumn("found", inspect("source_url", "target", F.lit(overwrite)))
        .select("*", "found.*")
        .drop("found")
        .checkpoint()
    )

    # A part whose size or offsets the source cannot serve is one range up to its end. A file without parts, which
    # is kept or cannot be fetched, stays as one row without a range.
    size = F.col("part.size")
    step = F.when(F.col("part.seekable"), F.lit(range_bytes)).otherwise(F.greatest(size, F.lit(1))).cast("bigint")
    offsets = F.sequence(F.lit(0).cast("bigint"), F.greatest(size - 1, F.lit(0)), step)
    ranges = (
        inspected.withColumn("part", F.explode_outer("parts"))
        .drop("parts")
        .withColumn("offset", F.explode_outer(F.when(F.col("part").isNotNull(), offsets)))
        .withColumn("length", F.when(size < 0, F.lit(-1)).otherwise(F.least(step, size - F.col("offset"))))
    )
    copied = (
        ranges.repartition(_copy_tasks(ranges, range_bytes))
        .withColumn("copy", copy_range("source_url", "part.name", "staged", "offset", "length", "part.version"))
        .drop("part", "offset", "length")
        .checkpoint()
    )

    files_copied = copied.groupBy([name for name in copied.columns if name != "copy"]).agg(
        F.sum("copy.bytes").alias("size"), F.min("copy.error").alias("copy_error")
    )
    done = publish("target", "staged", "kept", "size", F.coalesce("error", "copy_error"))
    return (
        files_copied.withColumn("done", done)
        .select(
            "year",
            "month",
            "source_url",
            "landing_path",
            F.col("done.status").alias("status"),
            F.col("done.size").alias("file_size_bytes"),
            F.col("started").alias("ingestion_started_at"),
            F.col("done.finished").alias("ingestion_finished_at"),
        )
        .checkpoint()
    )


def _copy_tasks(ranges: DataFrame, range_bytes: int) -> int:
    """One task per ``range_bytes`` to copy, so that small parts share a task, and none without a range."""
    length = F.col("length")
    of_unknown_size = F.when(length < 0, F.lit(range_bytes)).otherwise(length)
    rows, size = ranges.agg(F.count(F.lit(1)), F.coalesce(F.sum(of_unknown_size), F.lit(0))).first()
    at_least = ranges.sparkSession.sparkContext.defaultParallelism
    return max(1, min(rows, max(at_least, -(-size // range_bytes))))


def append_manifest(manifest: DataFrame, path: str, run: str | None = None) -> str:
    """Add the attempts of one run to the history at ``path``, and return the run's name.

    A run's attempts are one file, named after the run: adding them again under the same ``run``, as after a failure,
    replaces it, so the history has one row for each attempt at a file.
    """
    spark, run = manifest.sparkSession, run or uuid4().hex
    columns = [F.col(name).cast(kind).alias(name) for name, kind in MANIFEST_TYPES.items()]
    staged, target = f"{path}/.{run}", f"{path}/attempts-{run}.parquet"
    manifest.select(*columns).coalesce(1).write.mode("overwrite").parquet(staged)
    part = next(name for name in children(spark, staged) if name.startswith("part-"))
    delete(spark, target)
    rename(spark, f"{staged}/{part}", target)
    delete(spark, staged)
    return run


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """All attempts in the history."""
    return spark.read.schema(", ".join(f"{name} {kind.simpleString()}" for name, kind in MANIFEST_TYPES.items())).parquet(path)


def ingest_landing(
    spark: SparkSession,
    published_base: str,
    landing_base: str,
    year: int = DEFAULT_YEAR,
    months=DEFAULT_MONTHS,
    overwrite: bool = False,
    manifest_path: str | None = None,
    mount: tuple[str, str] = ("file:", ""),
    by: str = "bytes",
) -> DataFrame:
    """Fetch the months into the landing area, add the attempts to the manifest, and return them.

    ``by="bytes"`` copies files as they are, into a landing area that tasks can write to as a file system.
    ``by="rows"`` goes through Spark's readers and writers, into any storage that Spark writes (``relay_files``).
    """
    if by not in ("bytes", "rows"):
        raise ValueError(f"by must be 'bytes' or 'rows', not {by!r}")
    files = landing_files(spark, published_base, landing_base, year, months)
    if by == "rows":
        from tripline.sources.relay import relay_files

        manifest = relay_files(files, overwrite)
    else:
        manifest = land_files(files, overwrite, mount)
    if manifest_path is not None:
        append_manifest(manifest, manifest_path)
    return manifest


def manifest_latest(manifest: DataFrame) -> DataFrame:
    """The last attempt at each monthly file."""
    others = [name for name in MANIFEST_TYPES if name not in ("year", "month")]
    last = F.max_by(F.struct(*others), "ingestion_started_at").alias("last")
    return manifest.groupBy("year", "month").agg(last).select("year", "month", "last.*")


def failed_files(manifest: DataFrame) -> DataFrame:
    """Monthly files whose last attempt neither fetched them nor found them in place."""
    return manifest_latest(manifest).where(F.col("status").startswith("failed"))

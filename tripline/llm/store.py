"""Tables between the steps of a job, in the shared folder."""

from __future__ import annotations

import atexit
import gc
import time
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from tripline.sources.scratch import checkpoint_root


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder, which is emptied when the driver ends."""
    path = f"{checkpoint_root(spark)}/tripline-llm/{uuid4().hex}-{name}"
    atexit.register(_removed, spark, path)
    return path


def _removed(spark: SparkSession, path: str) -> None:
    try:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)
    except Exception:  # the driver's JVM may be gone before
        pass


def stored(df: DataFrame, name: str, release: bool = False) -> DataFrame:
    """The rows written as Parquet and read back: cuts the lineage, and later steps start from files all tasks share.

    ``release`` lets Spark delete the shuffle files of the steps before, which nothing needs any more. It does so once
    the driver has collected its garbage, which may otherwise be long after a large step.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    if release:
        del df
        for _ in range(2):  # what the write still reports to listeners holds its plan for a moment
            time.sleep(0.5)
            gc.collect()
            spark.sparkContext._jvm.System.gc()
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more, before the driver ends."""
    for table in tables:
        _removed(table.sparkSession, table.stored_at)


def stored_in(spark: SparkSession, table: DataFrame) -> DataFrame:
    """A stored table, read by another session."""
    out = spark.read.schema(table.schema).parquet(table.stored_at)
    out.stored_at = table.stored_at
    return out

"""Writing layers as catalog tables."""

from __future__ import annotations

import re
from datetime import date
from urllib.parse import unquote
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripline.contract import Lakehouse, Period
from tripline.sources.filesystem import delete
from tripline.sources.local import local_table, side_by_side

OVERWRITE_PARTITIONS = "overwrite_partitions"

_BUILD_SETTINGS = {
    # A task that writes by month meets only a few months, so it can keep their files open side by side
    # instead of sorting its rows by month first. A task that meets more than these sorts them.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    # Eight bytes with statistics, which a range of pickups can be tested against. Spark's default for Parquet
    # is a legacy type of twelve bytes without usable statistics.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Partitions are the folders at a table's location, so that one change of the location changes them all.
    "spark.sql.hive.manageFilesourcePartitions": "false",
}


def build_session(spark: SparkSession) -> SparkSession:
    """A session of a build's own: the caller's settings and those of table writes. Tables and cluster are shared.

    The caller's session keeps its settings, so what it writes meanwhile is written as it asked for, and builds of
    different lakes do not wait for each other.
    """
    own = spark.newSession()
    for key, value in (spark.conf.getAll | _BUILD_SETTINGS).items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    return own


def _quoted(text: str) -> str:
    return "'{}'".format(text.replace("\\", "\\\\").replace("'", "\\'"))


def ensure_database(spark: SparkSession, lake: Lakehouse) -> None:
    place = f" LOCATION {_quoted(lake.location)}" if lake.location is not None else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {lake.database}{place}")


def write_table(
    df: DataFrame,
    lake: Lakehouse,
    layer: str,
    mode: str = "overwrite",
    partition_by: tuple[str, ...] = (),
) -> DataFrame:
    """Store ``df`` as the table of ``layer`` and return the stored table.

    ``mode`` is a Spark save mode, or ``overwrite_partitions``, which replaces the partitions ``df`` has rows
    for and leaves the others alone. Rows have no key, so ``append`` of the same rows stores them twice. No setting
    of the session is changed.
    """
    ensure_database(df.sparkSession, lake)
    return _store(df, lake, layer, mode, partition_by)


def write_tables(
    frames: dict[str, DataFrame], lake: Lakehouse, mode: str = "overwrite", partition_by: dict | None = None
) -> dict[str, DataFrame]:
    """``write_table`` for several layers at once: small ones need not wait for a large one."""
    if not frames:
        return {}
    spark = next(iter(frames.values())).sparkSession
    ensure_database(spark, lake)
    stored = side_by_side(
        spark, lambda layer: _store(frames[layer], lake, layer, mode, (partition_by or {}).get(layer, ())), frames
    )
    return dict(zip(frames, stored))


def _store(df: DataFrame, lake: Lakehouse, layer: str, mode: str, partition_by: tuple[str, ...]) -> DataFrame:
    spark = df.sparkSession
    name = lake.table(layer)
    _settle(spark, lake, layer)
    known = spark.catalog.tableExists(name)
    if lake.storage == "delta":
        writer = df.write.format("delta").mode("overwrite" if mode == OVERWRITE_PARTITIONS else mode)
        if mode == OVERWRITE_PARTITIONS and known:
            writer = writer.option("partitionOverwriteMode", "dynamic")
        else:
            writer = writer.option("overwriteSchema", "true")
        writer.partitionBy(*partition_by).saveAsTable(name)
    elif mode == OVERWRITE_PARTITIONS and known:
        # insertInto goes by position, and a stored table has its partition columns last.
        df.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
    elif not known or mode in ("overwrite", OVERWRITE_PARTITIONS):
        _store_whole(df, lake, layer, partition_by)
    else:
        writer = df.write.format(lake.storage).mode(mode)
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)
    spark.catalog.refreshTable(name)
    return spark.table(name)


def _store_whole(df: DataFrame, lake: Lakehouse, layer: str, partition_by: tuple[str, ...]) -> None:
    """Write a folder of its own, then make it the table's: readers see all of the old rows or all of the new ones.

    What is cut off before the change leaves the old table, and a folder that no table names. Where columns and types
    stay, the change is one of the table's location. Other columns need another table, which takes the name in two
    renames; ``_settle`` undoes the first one if the second did not come.
    """
    spark, name = df.sparkSession, lake.table(layer)
    own = build_session(spark)
    place = (lake.location or unquote(spark.catalog.getDatabase(lake.database).locationUri)).rstrip("/")
    folder = f"{place}/{getattr(lake, layer)}-{uuid4().hex}"
    rows = df.select(*(column for column in df.columns if column not in partition_by), *partition_by)
    try:
        rows.write.format(lake.storage).partitionBy(*partition_by).save(folder)
        if not spark.catalog.tableExists(name):
            _create(own, name, rows, lake.storage, partition_by, folder)
            return
        former = re.search(rf"/({getattr(lake, layer)}-[0-9a-f]{{32}})$", _location(own, name))
        if former and _shape(own.table(name)) == _shape(rows) and _partitions(own, name) == list(partition_by):
            _point_at(own, name, folder)
        else:
            _create(own, f"{name}{_NEW}", rows, lake.storage, partition_by, folder)
            _take_name(own, lake, layer)
    except Exception:
        if not spark.catalog.tableExists(name) or not _location(own, name).endswith(folder.rsplit("/", 1)[-1]):
            delete(spark, folder)
        raise
    if former:
        delete(spark, f"{place}/{former[1]}")


_NEW, _OLD = "__new", "__old"


def _create(spark: SparkSession, name: str, rows: DataFrame, storage: str, partition_by: tuple[str, ...], folder: str) -> None:
    # The table remembers the option: what is inserted later replaces the partitions it has rows for.
    parts = f"PARTITIONED BY ({', '.join(partition_by)}) " if partition_by else ""
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in rows.schema)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING {storage} OPTIONS (partitionOverwriteMode 'dynamic') "
              f"{parts}LOCATION {_quoted(folder)}")


def _point_at(spark: SparkSession, name: str, folder: str) -> None:
    spark.sql(f"ALTER TABLE {name} SET LOCATION {_quoted(folder)}")


def _take_name(spark: SparkSession, lake: Lakehouse, layer: str) -> None:
    name = lake.table(layer)
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}{_OLD}")
    spark.sql(f"ALTER TABLE {name}{_NEW} RENAME TO {name}")
    spark.sql(f"DROP TABLE {name}{_OLD}")


def _settle(spark: SparkSession, lake: Lakehouse, layer: str) -> None:
    """Give a table its name back that it had lost to one that never came."""
    name = lake.table(layer)
    if not spark.catalog.tableExists(name) and spark.catalog.tableExists(f"{name}{_OLD}"):
        spark.sql(f"ALTER TABLE {name}{_OLD} RENAME TO {name}")


def _shape(df: DataFrame) -> list[tuple[str, str]]:
    return [(field.name, field.dataType.simpleString()) for field in df.schema]


def _described(spark: SparkSession, name: str) -> list:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()


def _location(spark: SparkSession, name: str) -> str:
    return next(row.data_type for row in reversed(_described(spark, name)) if row.col_name == "Location").rstrip("/")


def _partitions(spark: SparkSession, name: str) -> list[str]:
    return [column.name for column in spark.catalog.listColumns(name) if column.isPartition]


def seen_by(spark: SparkSession, lake: Lakehouse, layer: str) -> DataFrame:
    """A table that another session has written, with its present files."""
    _settle(spark, lake, layer)
    spark.catalog.refreshTable(lake.table(layer))
    return spark.table(lake.table(layer))


def remember_period(spark: SparkSession, lake: Lakehouse, period: Period) -> None:
    """Store with the silver table which days count."""
    spark.sql(
        f"ALTER TABLE {lake.table('silver')} SET TBLPROPERTIES ('{_PERIOD}' = '{period.start} {period.end}')"
    )


def remembered_period(spark: SparkSession, lake: Lakehouse) -> Period | None:
    """The period the silver table was built for; None for a table that does not say."""
    found = spark.sql(f"SHOW TBLPROPERTIES {lake.table('silver')}").where(F.col("key") == _PERIOD).first()
    return Period(*map(date.fromisoformat, found.value.split())) if found else None


_PERIOD = "tripline.period"


def drop_lake(spark: SparkSession, lake: Lakehouse) -> None:
    """Remove the database of a lake with its tables."""
    spark.sql(f"DROP DATABASE IF EXISTS {lake.database} CASCADE")


def layer_tables(spark: SparkSession, lake: Lakehouse) -> DataFrame:
    """The five tables of the layers, and whether the catalog has them."""
    expected = local_table(spark, "table_name string", [(name,) for name in lake.table_names()])
    listed = (
        spark.sql(f"SHOW TABLES IN {lake.database}")
        .where("NOT isTemporary")
        .select(F.col("tableName").alias("table_name"), F.lit(True).alias("listed"))
    )
    return expected.join(listed, "table_name", "left").select(
        "table_name", F.coalesce("listed", F.lit(False)).alias("is_present")
    )


def drop_partitions(spark: SparkSession, lake: Lakehouse, layer: str, keys: list[dict[str, int]]) -> None:
    """Remove partitions that a new load has no rows for, which overwriting by partition leaves as they were."""
    name = lake.table(layer)
    for key in keys:
        tests = [f"{column} = {value}" for column, value in key.items()]
        if lake.storage == "delta":
            spark.sql(f"DELETE FROM {name} WHERE {' AND '.join(tests)}")
        else:
            delete(spark, "/".join([unquote(_location(spark, name)), *(f"{column}={value}" for column, value in key.items())]))
    spark.catalog.refreshTable(name)

"""Small things the driver starts from: tables of months or names, and jobs that need not wait for each other."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_Item = TypeVar("_Item")
_Result = TypeVar("_Result")

_JOBS_AT_A_TIME = 16


def local_table(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """``rows`` as a DataFrame of a known size, handed over as one Arrow table without a Python worker."""
    fields = StructType.fromDDL(schema)
    columns = list(zip(*rows)) or [()] * len(fields)
    return spark.createDataFrame(pa.table(dict(zip(fields.names, map(list, columns)))), fields)


def side_by_side(
    spark: SparkSession, job: Callable[[_Item], _Result], items: Iterable[_Item]
) -> list[_Result]:
    """Results of ``job`` per item. The jobs are submitted together and share the cluster; the first error is raised."""
    with ThreadPoolExecutor(_JOBS_AT_A_TIME) as pool:
        return list(pool.map(inheritable_thread_target(spark)(job), items))

"""Column names and types from the footers of Parquet files, read inside Spark tasks."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq

_COLUMNS = pa.list_(pa.struct([("name", pa.string()), ("type", pa.string())]))
_SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"
# Spark has no unsigned numbers, and reads these as the next larger type.
_UNSIGNED = {"uint8": "smallint", "uint16": "int", "uint32": "bigint", "uint64": "decimal(20,0)"}


def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the columns of each file, or what kept this process from opening it, as on storage that only Spark reads."""
    for batch in batches:
        found = [columns_of(path) for path in batch.column("path").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(name) for name in ("path", "year", "month")),
                pa.array([columns for columns, _ in found], _COLUMNS),
                pa.array([error for _, error in found], pa.string()),
            ],
            ["path", "year", "month", "columns", "error"],
        )


def columns_of(path: str) -> tuple[list[dict[str, str]] | None, str | None]:
    """The columns of a file as this process can open it, else None and the reason."""
    try:
        if re.match("file:|/", path):
            return types_of(pq.ParquetFile("/" + path.removeprefix("file:").lstrip("/"))), None
        filesystem, name = pa.fs.FileSystem.from_uri(path)
        with filesystem.open_input_file(name) as file:
            return types_of(pq.ParquetFile(file)), None
    except Exception as error:  # the driver opens it through Spark instead, and raises if that fails too
        return None, f"{type(error).__name__}: {error}"


def types_of(file: pq.ParquetFile) -> list[dict[str, str]]:
    """Names and Spark's names of the types: as the writer recorded them, if that was Spark."""
    from pyspark.sql.pandas.types import from_arrow_type
    from pyspark.sql.types import StructType

    schema = file.schema_arrow
    recorded = (schema.metadata or {}).get(_SPARK_SCHEMA)
    if recorded:
        fields = StructType.fromJson(json.loads(recorded)).fields
        return [{"name": field.name, "type": field.dataType.simpleString()} for field in fields]
    physical = {file.schema.column(k).path: file.schema.column(k).physical_type for k in range(len(file.schema))}

    def type_of(field: pa.Field) -> str:
        if physical.get(field.name) == "INT96":
            return "timestamp"
        return _UNSIGNED.get(str(field.type)) or from_arrow_type(field.type, prefer_timestamp_ntz=True).simpleString()

    return [{"name": field.name, "type": type_of(field)} for field in schema]

"""Bringing columns to the types a layer stores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def typed(types: dict[str, T.DataType]) -> list[Column]:
    """The columns of ``types``, in that order and type. A value that does not fit becomes NULL."""
    return [F.col(name).try_cast(kind).alias(name) for name, kind in types.items()]

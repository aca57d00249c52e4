"""Shared folders for checkpoints and intermediate tables."""

from __future__ import annotations

import re
import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession

from tripline.sources.filesystem import delete


def checkpoint_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a session whose tasks run in the driver's own process, as in a test, gets a temporary folder instead where
    none is named: other processes or machines may not share it.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named is None:
        if re.match(r"local(\[|$)", context.master) is None:
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        named = tempfile.mkdtemp(prefix="tripline-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named.rstrip("/")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path of its own below the checkpoint folder; nothing is created yet."""
    return f"{checkpoint_root(spark)}/{purpose}-{uuid4().hex}"


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete folders that a query has made and that nothing reads any more."""
    for path in paths:
        delete(spark, path)

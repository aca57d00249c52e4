"""Small tables of vectors with every awkward case."""

from __future__ import annotations

import math
import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(spark: SparkSession, rows: list) -> DataFrame:
    return spark.createDataFrame(rows, SCHEMA)


def awkward(n: int = 400, width: int = 8, seed: int = 3) -> list:
    """Nulls anywhere, what is no number, ties, repeated rows, and one vector that a third of all rows share."""
    draw = random.Random(seed)
    rows: list = []
    for k in range(n):
        vector = [draw.choice((-1, 1)) * draw.randrange(0, 96) / 128 for _ in range(width)]
        rows.append((k, [0.5, -0.25] * (width // 2) if k % 3 == 0 else vector, draw.choice([0, 1, 1, 2, None])))
    rows += rows[5:25]
    rows += [(100, rows[7][1], 1), (100, rows[7][1], 1), (None, rows[8][1], 1), (None, None, None), (200, None, 1)]
    rows += [(300, [math.nan] * width, 1), (300, [math.inf, *[0.0] * (width - 1)], 0), (500, [None, *[0.5] * (width - 1)], 2)]
    rows += [(600, [], 1), (-700, rows[10][1], 1), (-7, rows[11][1], 2), (700, [0.0] * width, 1), (800, [-0.5] * width, 0)]
    draw.shuffle(rows)
    return rows


def usable(rows: list) -> list:
    """The rows that have components, all of them numbers."""
    return [row for row in rows if row[1] and all(x is not None and math.isfinite(x) for x in row[1])]

"""Every registered query against its SQL, run by DuckDB over the same files."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from tripline.plans import registry
from tests.conftest import TESTDATA

SIZES = ["sf0.01"]


@pytest.fixture(scope="session", params=SIZES)
def data(request):
    folder = TESTDATA / request.param
    connection = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    yield str(folder), connection
    connection.close()


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(value):
        return "NaN" if isinstance(value, float) and math.isnan(value) else value

    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(registry.oracle_sql())
    assert set(driver.oracle_sql()) <= set(driver.queries())


# Names the two engines give the same type.
DUCK_TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
}


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_oracle(spark, data, name):
    folder, connection = data
    actual = driver.queries()[name](spark, folder)
    expected = connection.execute(driver.oracle_sql()[name])
    types = {column[0]: DUCK_TYPES[str(column[1])] for column in expected.description}
    assert dict(actual.dtypes) == types
    wanted = _rows(list(types), expected.fetchall())
    assert wanted
    assert _rows(actual.columns, [tuple(row) for row in actual.collect()]) == wanted


def test_entry(spark):
    assert driver.entry(spark).count() == 5

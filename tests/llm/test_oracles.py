"""The queries of this subpackage against their SQL, and that all are registered."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from tests.test_oracles import DUCK_TYPES, _rows, data  # noqa: F401
from tripline.llm import queries


def test_registered():
    numbers = [name.split("_")[0] for name in queries.queries()]
    assert [f"op{k}" for k in range(1, 14)] == [x for x in numbers if x.startswith("op")]
    assert set(queries.queries()) <= set(driver.queries())
    assert set(queries.oracle_sql()) <= set(queries.queries())


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_oracle(spark, data, name):  # noqa: F811
    folder, connection = data
    actual = queries.queries()[name](spark, folder)
    expected = connection.execute(queries.oracle_sql()[name])
    types = {column[0]: DUCK_TYPES[str(column[1])] for column in expected.description}
    assert dict(actual.dtypes) == types
    wanted = _rows(list(types), expected.fetchall())
    assert len(wanted) >= 100
    assert _rows(actual.columns, [tuple(row) for row in actual.collect()]) == wanted

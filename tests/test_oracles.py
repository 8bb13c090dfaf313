"""Every check query against its SQL on the same tables."""

import pytest

import __spark_entry__ as entry_points

from rillflow.plans.checks import QUERIES
from rillflow.plans.oracles import ORACLES

KINDS = {"boolean": "BOOLEAN", "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE"}


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    columns = sorted(result.columns)
    cursor = duck.execute(ORACLES[name])
    kinds = {column[0]: str(column[1]) for column in cursor.description}
    expected = cursor.fetch_df()
    assert {f.name: KINDS[f.dataType.simpleString()] for f in result.schema} == kinds
    got = sorted(tuple(repr(row[c]) for c in columns) for row in result.collect())
    rows = expected[columns].astype(object).where(expected[columns].notna(), None)
    want = sorted(tuple(repr(_plain(value)) for value in row) for row in rows.itertuples(index=False))
    assert len(got) == len(want) > 0
    assert got == want


def _plain(value):
    if isinstance(value, float) and value.is_integer():
        return value
    return value.item() if hasattr(value, "item") else value


def test_entry_returns_rows(spark):
    assert entry_points.entry(spark).count() > 0

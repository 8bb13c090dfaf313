"""Every training-data query that has SQL against it, on the same tables."""

import pytest

from rillflow.llm.oracles import ORACLES
from rillflow.llm.queries import QUERIES

KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="session")
def tables(sf_dir):
    import duckdb

    connection = duckdb.connect()
    for name in "documents embeddings pages benchmark labels conversations".split():
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", ORACLES)
def test_query_matches_sql(spark, tables, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    columns = sorted(result.columns)
    cursor = tables.execute(ORACLES[name])
    kinds = {column[0]: str(column[1]) for column in cursor.description}
    rows = cursor.fetchall()
    assert {f.name: KINDS[f.dataType.simpleString()] for f in result.schema} == kinds
    order = [list(kinds).index(c) for c in columns]
    want = sorted(repr([row[k] for k in order]) for row in rows)
    got = sorted(repr([row[c] for c in columns]) for row in result.collect())
    assert len(got) > 0 and got == want

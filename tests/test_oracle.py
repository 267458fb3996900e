"""Every registered query against the same question asked in SQL."""

import math
from collections import Counter

import duckdb
import pytest

from panelweave import suite

QUERIES, ORACLE = suite.QUERIES | suite.SCAN_QUERIES, suite.ORACLE | suite.SCAN_ORACLE

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(data_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{data_dir}/{name}.parquet')"
        )
    yield connection
    connection.close()


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


SPARK_TO_DUCK = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(name, spark, duck, data_dir):
    frame = QUERIES[name](spark, data_dir)
    actual = _bag(frame.columns, [tuple(r) for r in frame.collect()])

    result = duck.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    expected = _bag(columns, result.fetchall())

    assert sorted(frame.columns) == sorted(columns)
    assert {f.name: SPARK_TO_DUCK[f.dataType.simpleString()] for f in frame.schema.fields} == types
    assert sum(expected.values()) > 0, "the fixture gives the query nothing to do"
    difference = (actual - expected, expected - actual)
    assert actual == expected, [list(d.items())[:3] for d in difference]

"""The entry points a driver calls."""

import duckdb

import __spark_entry__ as entry_points


def test_flagship(spark):
    frame = entry_points.entry(spark)
    assert frame.columns == ["yr", "n_added", "n_removed", "n_changed", "n_unchanged"]
    totals = frame.agg({name: "sum" for name in frame.columns[1:]}).first()
    assert sum(totals) == 1500


def test_every_query_can_be_checked():
    queries, oracle = entry_points.queries(), entry_points.oracle_sql()
    assert set(oracle) <= set(queries) and all(callable(q) for q in queries.values())
    connection = duckdb.connect()
    for sql in oracle.values():
        assert connection.extract_statements(sql)

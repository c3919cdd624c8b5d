"""Every registered query of the library against its DuckDB twin."""

import pytest
from oracle import compare

from tessera import queries

queries.load()


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_twin(spark, name):
    compare(spark, queries.QUERIES[name], queries.SQL[name])


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(queries.QUERIES) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())

"""Every registered query against its SQL on the smallest tables."""

import pytest

from tests.compare import connect, difference
from tidemark.queries import REGISTRY

DIRECTORY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(DIRECTORY)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, con, name):
    query = REGISTRY[name]
    df = query(spark, DIRECTORY)
    if query.sql:
        assert difference(df, con, query.sql) is None
    else:
        assert df.columns and df.count() > 0


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns[0] == "transaction_id"

import pytest

from oracle import connect, same
from statutegraph import registry


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    same(registry.QUERIES[name](spark, sf_dir), con, registry.ORACLES[name])


def test_entry_points_name_the_same_queries():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert set(registry.QUERIES) <= set(e.queries())

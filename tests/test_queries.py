import pytest

from tests import oracle
from tracewright.plans import queries

pytestmark = pytest.mark.skipif(not oracle.available(), reason="no shared tables")


@pytest.mark.parametrize("name", queries.QUERIES)
def test_rows_equal_sql(spark, name):
    oracle.same(spark, queries.QUERIES[name], queries.ORACLES[name])


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())

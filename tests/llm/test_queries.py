import pytest

from tests import oracle
from tracewright.llm import oracles, queries

pytestmark = pytest.mark.skipif(not oracle.available(), reason="no shared tables")


@pytest.mark.parametrize("name", oracles.ORACLES)
def test_rows_equal_sql(spark, name):
    oracle.same(spark, queries.QUERIES[name], oracles.ORACLES[name])


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))

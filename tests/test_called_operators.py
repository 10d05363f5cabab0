"""Queries call the operator they stand for."""

import pytest

from tests import oracle
from tracewright.plans import queries

pytestmark = pytest.mark.skipif(not oracle.available(), reason="no shared tables")


@pytest.mark.parametrize("name, module, operator", [("s13_size_guard", "delivery", "size_warnings"), ("k2_route", "export", "validate"), ("e9_last_role", "export", "validate")])
def test_operator_is_called(spark, monkeypatch, name, module, operator):
    calls, own = [], getattr(getattr(queries, module), operator)
    monkeypatch.setattr(getattr(queries, module), operator, lambda *a: calls.append(name) or own(*a))
    queries.QUERIES[name](spark, oracle.FOLDER)
    assert calls == [name]

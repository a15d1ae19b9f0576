"""Every registered query against its SQL, values exact."""

from __future__ import annotations

import pytest
from __spark_entry__ import entry, oracle_sql, queries

from tapeloom.registry.queries import QUERIES

from tests.compare import assert_equal, connect


@pytest.fixture(scope="module")
def db(testdata):
    return connect(testdata / "sf0.01")


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(queries())
    assert set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, db, testdata, name, capsys):
    df = queries()[name](spark, str(testdata / "sf0.01"))
    df.explain()
    plan = capsys.readouterr().out
    assert not [step for step in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas") if step in plan]
    assert assert_equal(df, db, oracle_sql()[name]) > 0


def test_entry(spark):
    assert entry(spark).columns[0] == "EXCHANGE"

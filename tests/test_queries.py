"""Every registered query against DuckDB on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import differences
from cubestar.catalog import inputs
from cubestar.catalog.registry import ORACLES, QUERIES


def test_every_query_has_a_comparison():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries())
    assert set(ORACLES) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() > 0


def test_derived_inputs_leave_the_views_of_the_session(spark, sf):
    views = lambda: {t.name for t in spark.catalog.listTables() if t.isTemporary}
    before = views() - {"orders"}
    spark.range(3).createOrReplaceTempView("orders")
    derived = inputs.derive(spark, sf, "new_batch")
    assert views() == {*before, "orders"} and spark.table("orders").columns == ["id"]
    spark.catalog.dropTempView("orders")
    assert derived.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf, name):
    problem, _ = differences(QUERIES[name](spark, sf), con, ORACLES[name])
    assert problem == ""

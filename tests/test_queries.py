from __future__ import annotations

import pytest
from support import SF, same

from handbill.plans import queries


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_matches_sql(spark, duck, name):
    same(queries.QUERIES[name](spark, SF), duck, queries.SQL[name])


def test_filter_reaches_the_scan(spark):
    """Only the columns in use are read, and the flagship filters before it dedups."""
    plan = queries.first_wins_dedup(spark, SF)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "props" not in plan.split("ReadSchema")[-1]


def test_entry():
    import __spark_entry__ as e

    assert set(queries.QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())

"""Every registered query of the monthly layers agrees with its DuckDB twin."""

import pytest
from oracle import assert_same, duck

from monthmill import queries as Q

QUERIES, ORACLES = Q.queries(), Q.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, name):
    got = QUERIES[name](spark, sf)
    if name in ORACLES:
        assert_same(got.toPandas(), duck(sf, ORACLES[name]))
    else:
        assert got.count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(ORACLES) <= set(entry.oracle_sql()) and set(QUERIES) <= set(entry.queries())

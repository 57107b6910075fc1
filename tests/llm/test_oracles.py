import pytest
from oracle import assert_same, duck

from monthmill.llm import queries as Q


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_oracle(spark, sf, name):
    assert_same(Q.queries()[name](spark, sf).toPandas(), duck(sf, Q.oracle_sql()[name]))

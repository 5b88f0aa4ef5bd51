"""Every query with SQL equals its oracle over whole tables."""

import pytest

from compare import connect, difference, type_difference
from satmart.llm import oracle, queries

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_equals_oracle(spark, name):
    con = connect(SF)
    df = queries.QUERIES[name](spark, SF)
    assert type_difference(df, con, oracle.SQL[name]) is None
    assert difference(df, con, oracle.SQL[name]) is None

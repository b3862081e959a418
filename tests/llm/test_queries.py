"""The SQL of the operators' queries against what they return."""

import pytest

from sparkloom.llm import queries
from tests.test_catalog import same


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, data, duck, name):
    df = queries.QUERIES[name](spark, data)
    names = sorted(df.columns)
    got = sorted((tuple(same(r[n]) for n in names) for r in df.collect()), key=str)
    duck.execute(queries.ORACLES[name])
    columns = [d[0] for d in duck.description]
    assert sorted(columns) == names and got
    assert got == sorted((tuple(same(r[columns.index(n)]) for n in names) for r in duck.fetchall()), key=str)

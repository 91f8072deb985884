"""Every registered query against its SQL on the smallest tables, and the driver's contract."""

from collections import Counter

import pytest

import __spark_entry__ as entry
from tools.compare import connect, normalized

SF = "/root/testdata/sf0.001"
NAMES = sorted(entry.queries())


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    result = entry.entry(spark)
    assert result.columns and result.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    ours = normalized(df.columns, [tuple(r) for r in df.collect()])
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert ours
        return
    result = duck.execute(sql)
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert Counter(ours) == Counter(normalized(columns, result.fetchall()))

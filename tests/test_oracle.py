"""Every query with checking SQL, side by side on the smallest tables."""

import pytest

import __spark_entry__ as entry
from check_oracle import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cursor = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert compare(rows, df.columns, cursor.fetchall(), columns) == ""


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 4

import pytest
from check_oracles import compare, open_database

from __spark_entry__ import entry, oracle_sql, queries


@pytest.fixture(scope="module")
def database():
    return open_database("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_its_sql(spark, database, small, name):
    equal, message = compare(spark, database, small, name)
    assert equal, message


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0

import pytest

import __spark_entry__ as entry
from tests.sql_check import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    assert difference(spark, duck, SF_DIR, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0

"""Every registered query against its SQL, over whole tables; and the shape of the main plans."""

import pytest
from compare import difference

import __spark_entry__ as entry
from homelake.registry.oracle import ORACLE
from homelake.registry.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_each_query_has_sql():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    assert difference(spark, FOLDER, QUERIES[name], ORACLE[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0

"""Every registered query with SQL, against that SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
import check_oracle

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check_oracle.connect(SF)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 24


def test_each_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    verdict, _, _ = check_oracle.compare(con, spark, name, SF)
    assert verdict == "ok"

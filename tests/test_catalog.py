"""Every query against its SQL twin on the smallest tables."""

import pytest
from compare import connect, difference

import __spark_entry__ as driver

SF_DIR = "/root/testdata/sf0.001"
TWINS = driver.oracle_sql()
QUERIES = driver.queries()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(TWINS))
def test_equals_twin(spark, duck, name):
    assert difference(QUERIES[name](spark, SF_DIR), duck, TWINS[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(TWINS)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry_has_rows_for_every_product(spark):
    rows = driver.entry(spark).collect()
    assert {r["rank"] for r in rows} == {1, 2, 3, 4, 5}

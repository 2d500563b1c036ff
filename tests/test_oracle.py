"""Every query with SQL gives the same rows as DuckDB."""

import compare
import pytest

import __spark_entry__ as contract


@pytest.fixture(scope="module")
def db(folder):
    return compare.connect(folder)


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_equals_sql(spark, folder, db, name):
    result = contract.queries()[name](spark, folder)
    assert compare.differences(result, db, contract.oracle_sql()[name]) == []


@pytest.mark.parametrize(
    "name", sorted(set(contract.queries()) - set(contract.oracle_sql()))
)
def test_has_rows(spark, folder, name):
    assert contract.queries()[name](spark, folder).count() > 0


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert [row.group_id for row in rows] == [0, 1, 2, 3, 4]
    assert sum(row.n_rows for row in rows) == 150

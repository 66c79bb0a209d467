"""Every registered query against its check query, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from conftest import SMALL

CHECKS = entry.oracle_sql()
ROWS_ONLY = sorted(set(entry.queries()) - set(CHECKS))


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


def test_every_check_belongs_to_a_query():
    assert set(CHECKS) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_result_matches_its_check(spark, connection, name):
    assert differences(spark, connection, SMALL, entry.queries()[name], CHECKS[name]) == []


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_query_without_check_gives_rows(spark, name):
    assert entry.queries()[name](spark, SMALL).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0

"""Every registered query beside its SQL."""

import pytest

import __spark_entry__ as contract
import check

NAMES = list(contract.oracle_sql())


@pytest.fixture(scope="module")
def connection(sf_dir):
    return check.oracle_connection(sf_dir)


def test_every_query_has_its_sql():
    own = contract.llm_queries.queries() if contract.llm_queries else {}
    assert set(contract.queries()) - set(own) <= set(NAMES) <= set(contract.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, connection, sf_dir, name):
    outcome = check.compare(spark, connection, sf_dir, name)
    assert outcome == ""


def test_entry(spark):
    assert contract.entry(spark).count() == 10

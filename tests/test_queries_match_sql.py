"""Every registered query with SQL gives exactly the rows of its SQL."""

import pytest
from compare import compare, connect

from conftest import SF_DIR
from flowsieve.registry import QUERIES, SQL


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, connection, name):
    problems, rows = compare(spark, connection, name, QUERIES[name], SQL[name], SF_DIR)
    assert not problems
    # The smallest tables have no alerts that far back.
    assert rows > 0 or name == "deep_alert_page"


def test_every_statement_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_names_do_not_clash_with_reserved_forms():
    assert all(name == name.lower() and not name.startswith("op") for name in QUERIES)

"""Every registered query against its SQL."""

import pytest

from acceptance import catalog, oracle
from acceptance.compare import differences, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(oracle.oracle_sql())


@pytest.mark.parametrize("name", catalog.queries())
def test_query(spark, connection, name):
    assert differences(catalog.queries()[name](spark, SF), oracle.oracle_sql()[name], connection) == []

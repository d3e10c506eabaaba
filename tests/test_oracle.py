"""Every query against its SQL on the smallest data set."""

import pytest
from compare import differences, duck
from conftest import SF_DIR

from tickloom.suite import QUERIES
from tickloom.suite_sql import ORACLE


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, con, name):
    problem, _ = differences(spark, SF_DIR, name, con)
    assert problem is None, problem

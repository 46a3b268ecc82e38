"""All registered queries against their SQL."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import differences, duck
from tests.conftest import DATA


@pytest.fixture(scope="module")
def con():
    return duck(DATA)


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, con, name):
    assert differences(spark, con, name, DATA) is None


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0

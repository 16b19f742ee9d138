"""Every core query against its SQL twin, and those without one for rows, over the smallest tables."""

import pytest

from curatrix import plans
from tests.oracle import connect, differences

FOLDER = "/root/testdata/sf0.001"
SQL = plans.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    assert differences(spark, FOLDER, plans.queries()[name], SQL[name], con) == ""


@pytest.mark.parametrize("name", sorted(set(plans.queries()) - set(SQL)))
def test_runs(spark, name):
    assert plans.queries()[name](spark, FOLDER).count() > 0


def test_entry_loads():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())

"""Training-data queries against their SQL twins over the smallest tables."""

import pytest

from curatrix.llm import oracle, queries
from tests.oracle import connect, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_matches_sql(spark, name):
    assert differences(spark, FOLDER, queries.queries()[name], oracle.oracle_sql()[name], connect(FOLDER)) == ""

"""Every registered query against its oracle SQL on the smallest tables."""

import pytest

from tests.oracle import compare, connect
from tidemark.registry import ORACLES, QUERIES


LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, con, folder, name):
    message = compare(spark, con, folder, name)
    if message == "EMPTY":  # such rows are rare: look at ten times as many
        message = compare(spark, connect(LARGER), LARGER, name)
    assert message is None, message


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, folder, name):
    df = QUERIES[name](spark, folder)
    assert df.columns and df.count() >= 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)

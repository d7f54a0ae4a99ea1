"""Each query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
import check

FOLDER = "/root/testdata/sf0.001"
# A hundred forests take minutes at any size; the search itself is tested in test_evaluation.  SLOW_TESTS=1 runs it here too.
SLOW = set() if os.environ.get("SLOW_TESTS") else {"forest_search"}


@pytest.fixture(scope="module")
def con():
    return check.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - SLOW))
def test_query_equals_sql(spark, con, name):
    result = check.compare(spark, con, FOLDER, name)
    assert result.startswith("ok") and "TYPES" not in result, result


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["lang", "term", "weight", "rank"] and df.count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())

"""Every registered query with an SQL twin must give the twin's rows; the others must run."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()
# full-size fits of half a minute and more, run where TEST_SLOW is set; test_models covers what they call
SLOW = {"mdl_gradient_boosting", "mdl_rbf_svm", "mdl_random_search", "mdl_registry", "mdl_best_model"}
if os.environ.get("TEST_SLOW"):
    SLOW = set()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(set(ORACLES) - SLOW))
def test_same_rows_as_sql(spark, sf_dir, con, name):
    assert compare(spark, con, name, QUERIES[name], ORACLES[name], sf_dir) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - SLOW))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry_has_a_stable_schema(spark):
    assert entry.entry(spark).columns == ["mob", "bad_rate", "loans"]


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)

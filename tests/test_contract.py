"""The registered queries against their SQL on the small tables."""

import os
import re

import pytest
from check_oracles import compare, connect

import __spark_entry__ as contract

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


@pytest.fixture(scope="module")
def database():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    """But for those of the llm subpackage, which SQL cannot express and tests of their own cover."""
    without = contract.queries().keys() - contract.oracle_sql().keys()
    assert all(re.match(r"op\d+_|pipeline$", name) for name in without)
    assert contract.oracle_sql().keys() <= contract.queries().keys()


@needs_tables
@pytest.mark.parametrize("name", contract.oracle_sql())
def test_query_equals_its_sql(spark, database, name):
    assert compare(spark, database, name, FOLDER) == ""


@needs_tables
def test_entry_returns_the_best_documents(spark):
    best = contract.entry(spark)
    assert best.columns == ["title", "tfidf"]
    assert 0 < best.count() <= 100

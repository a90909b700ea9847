"""Every registered query against its SQL counterpart on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as entry
from compare import compare, connect

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_entry_runs(spark):
    result = entry.entry(spark)
    assert result.count() > 0 and result.columns[1] == "new_sequencia_error"


def test_every_counterpart_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    assert compare(spark, con, entry.queries()[name], entry.oracle_sql().get(name), FOLDER) is None

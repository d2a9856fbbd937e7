"""Every registered query against its SQL, exactly, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tools.check_oracle import compare, connect

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    assert compare(spark, con, name, FOLDER) == ""


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert len(entry.entry(spark).columns) == 68

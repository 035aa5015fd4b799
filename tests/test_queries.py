"""Every registered query next to its check SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from compare import DATA, compare, duck

FOLDER = f"{DATA}/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    state, rows, _, _, info = compare(spark, con, FOLDER, name, entry.queries()[name], entry.oracle_sql().get(name))
    assert state == ("ok" if name in entry.oracle_sql() else "rows-only") and rows > 0, info


def test_every_check_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "genre" and df.count() > 0

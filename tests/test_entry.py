import os

import pytest

import __spark_entry__ as entry


@pytest.mark.skipif(not os.path.isdir(entry.TESTDATA), reason="needs the generated tables")
def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() > 0


def test_oracles_name_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())

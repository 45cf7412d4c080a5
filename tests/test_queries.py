"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest
from check_queries import compare, duck

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    if not Path(SF).exists():
        pytest.skip("no test tables")
    return duck(SF)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    good, text = compare(spark, con, name, SF)
    assert good, text


def test_entry_and_checks(spark):
    assert entry(spark).count() > 0
    assert set(oracle_sql()) <= set(queries())

"""Every query with an oracle matches DuckDB on the small tables (the driver's
gate runs the same comparison at sf0.01), and the flagship entry runs."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle_check import compare

ORACLE_KEYS = sorted(entry.oracle_sql())


def test_every_oracle_has_a_query():
    assert set(ORACLE_KEYS) <= set(entry.queries())


@pytest.mark.parametrize("name", ORACLE_KEYS)
def test_query_matches_oracle(spark, name):
    status = compare(spark, SF_SMALL, [name], verbose=False)[name]
    assert status[0] == "OK", status


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:4] == ["main_category", "viewed", "cart", "purchased"]

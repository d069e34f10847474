"""Driver contract: entry() and every query key against the DuckDB oracle, at sf0.001."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as contract  # noqa: E402
from check_oracle import digest, duck  # noqa: E402
from tillroll.plans.catalog import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["WeekStartDate", "WeeklyRevenue"]
    assert df.count() == 341


def test_every_key_has_oracle_sql():
    assert set(QUERIES) <= set(contract.oracle_sql()) and set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_key_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(contract.oracle_sql()[key])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)

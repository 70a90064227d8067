"""Registered queries against their SQL over the smallest driver tables."""

import os

import pytest
from oracle_check import compare, connect

from ledgerloom.plans.catalog import QUERIES
from ledgerloom.plans.oracle import ORACLES

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {"source_fingerprints"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    problem, _ = compare(spark, duck, SF, QUERIES[name], ORACLES[name])
    assert problem is None


def test_entry_runs(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0 and "record_hash" in df.columns


def test_fingerprints_cover_every_table_file(spark):
    rows = QUERIES["source_fingerprints"](spark, SF).collect()
    assert len(rows) == 14 and all(len(r["sha256"]) == 64 and r["bytes"] > 0 for r in rows)

"""Every registered query equals its DuckDB twin on the whole sf0.001 tables."""

import pytest

import __spark_entry__ as E
from earshot.plans import oracle, suite
from harness import compare

NAMES = sorted(suite.queries())


def test_every_query_has_an_oracle():
    missing = set(NAMES) - set(oracle.sql())
    assert not missing, missing
    assert set(NAMES) <= set(E.queries()) and set(NAMES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_duckdb(spark, duck_small, name):
    from conftest import SF_SMALL
    df = suite.queries()[name](spark, SF_SMALL)
    r = compare(spark, duck_small, name, df, oracle.sql()[name])
    assert r["ok"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["title", "artist", "skip_count", "avg_sec_before_skip", "unique_skippers"]
    rows = df.collect()
    assert 0 < len(rows) <= 10
    assert [r.skip_count for r in rows] == sorted((r.skip_count for r in rows), reverse=True)

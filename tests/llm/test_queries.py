"""The registered queries: names, and the DuckDB twin of the one that SQL can express."""

import re

from harness import compare, duck

from earshot.llm import queries

SF = "/root/testdata/sf0.01"


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.queries()) == list(range(1, 14))
    assert set(queries.oracle_sql()) <= set(queries.queries())


def test_decontamination_equals_duckdb(spark):
    name = "op4_decontamination"
    r = compare(spark, duck(SF), name, queries.queries()[name](spark, SF), queries.oracle_sql()[name])
    assert r["ok"], r

"""Compares a registered query with its DuckDB SQL."""

from citymarts.llm.queries import ORACLE, QUERIES
from oracle_check import canon, duck


def assert_equals_sql(spark, key, sf_dir):
    got, want = QUERIES[key](spark, sf_dir).toPandas(), duck(sf_dir).execute(ORACLE[key]).df()
    assert sorted(got.columns) == sorted(want.columns)
    a, b = canon(got), canon(want)
    assert len(a) == len(b)
    assert a == b, [x for x in zip(a, b) if x[0] != x[1]][:3]

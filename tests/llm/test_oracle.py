"""The corpus operators that SQL can express give the same rows as their SQL counterparts."""

from collections import Counter

import duckdb
import pytest

from lodestone.llm import oracle, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_same_rows(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = queries.queries()[name](spark, SF), con.sql(oracle.oracle_sql()[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert Counter(tuple(r[c] for c in columns) for r in got.collect()) == Counter(want.project(", ".join(columns)).fetchall())

"""Corpus queries against their DuckDB equivalents."""

import duckdb
import pytest

from leafmill.llm.queries import oracle_sql, queries


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_equals_oracle(spark, data, name):
    c = duckdb.connect()
    for t in ("documents", "labels", "pages", "sale_lines", "conversations", "embeddings"):
        c.sql(f"create view {t} as select * from '{data}/{t}.parquet'")
    df, told = queries()[name](spark, data), c.sql(oracle_sql()[name])
    order = sorted(df.columns)
    assert order == sorted(told.columns)
    want = sorted(str([r[told.columns.index(k)] for k in order]) for r in told.fetchall())
    assert sorted(str([r[k] for k in order]) for r in df.collect()) == want

"""Every query against its DuckDB equivalent."""

import os

import duckdb
import pytest

from leafmill.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(data):
    c = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{data}/{t}.parquet"):
            c.sql(f"create view {t} as select * from '{data}/{t}.parquet'")
    return c


def rows(found, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(float(r[i])) if isinstance(r[i], float) else str(r[i]) for i in order) for r in found)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_equals_oracle(spark, data, duck, name):
    df = catalog.queries()[name](spark, data)
    told = duck.sql(catalog.oracle_sql()[name])
    assert sorted(df.columns) == sorted(told.columns)
    assert rows(df.collect(), df.columns) == rows(told.fetchall(), told.columns)


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_runs(spark, data, name):
    catalog.queries()[name](spark, data).collect()

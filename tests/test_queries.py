"""Every registered query against its SQL on DuckDB, over whole tables."""

import os

import duckdb
import pandas as pd
import pytest

from glycotide.plans import catalogue

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        path = f"{SMALL}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*' if os.path.isdir(path) else path}'")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    def text(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
            return ""
        return f"{v:.6g}" if isinstance(v, float) else str(v)

    df = df[sorted(df.columns)].map(text)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def test_every_query_has_its_sql():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLES)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_sql(spark, duck, name):
    ours, theirs = normal(catalogue.QUERIES[name](spark, SMALL).toPandas()), normal(duck.execute(catalogue.ORACLES[name]).df())
    assert list(ours.columns) == list(theirs.columns)
    pd.testing.assert_frame_equal(ours, theirs)


def test_entry_module(spark):
    import __spark_entry__ as entry

    assert set(catalogue.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns

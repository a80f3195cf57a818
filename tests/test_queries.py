"""Every query that has SQL against DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return db


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables here")
@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, duck, name):
    got = entry.queries()[name](spark, DATA).toPandas()
    want = duck.sql(entry.oracle_sql()[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    got, want = (x[columns].sort_values(columns, key=lambda s: s.astype(str)).reset_index(drop=True) for x in (got, want))
    assert len(got) == len(want)
    for c in columns:
        assert ((got[c] == want[c]) | (got[c].isna() & want[c].isna())).all(), c


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables here")
def test_entry(spark):
    assert entry.entry(spark).count() == 2048

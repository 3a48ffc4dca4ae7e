"""Every registered query with SQL, held against DuckDB on the smallest tables."""

import glob
import os

import duckdb
import pytest

from quillsieve.plans.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables aren't here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)
    result = duck.execute(ORACLES[name])
    at = [[d[0] for d in result.description].index(c) for c in columns]
    assert got == sorted((tuple(r[i] for i in at) for r in result.fetchall()), key=str)


def test_names():
    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) > 50

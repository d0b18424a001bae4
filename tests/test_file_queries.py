"""Raw files of every source, written from the driver's tables and read back, against SQL on the tables."""

import glob
import os

import duckdb
import pytest

from tomeflow.plans import file_queries

SF = "/root/testdata/sf0.001"
NAMES = [name for name, fn in file_queries.QUERIES.items() if fn.__module__ == file_queries.__name__]


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_rows_are_those_of_the_sql(spark, oracle, name):
    df = file_queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    found = sorted(repr(tuple(r)) for r in df.select(columns).collect())
    quoted = ", ".join(f'"{c}"' for c in columns)
    want = oracle.execute(f"SELECT {quoted} FROM ({file_queries.SQL[name]})").fetchall()
    assert found and found == sorted(map(repr, want))

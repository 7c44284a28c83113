"""Every library query with SQL against DuckDB on the smallest tables."""

import glob
import os

import duckdb
import pytest

from viewloom import queries as library

QUERIES, SQL = library.queries(), library.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def rows(frame):
    frame = frame[sorted(frame.columns)]

    def text(v):
        if v is None or v != v:
            return "NULL"
        if isinstance(v, (bool, str)) or type(v).__name__ == "bool_":
            return str(v)
        return format(float(v), ".12g")

    return list(frame.columns), sorted(tuple(map(text, r)) for r in frame.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf_dir, duck, name):
    assert rows(QUERIES[name](spark, sf_dir).toPandas()) == rows(duck.execute(SQL[name]).fetchdf())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0

"""Every registered query that has SQL gives the same rows as DuckDB on the same tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_point

TABLES = "documents embeddings benchmark labels conversations".split()
ORACLES = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{os.path.join(sf, name)}.parquet'")
    return connection


def plain(frame: pd.DataFrame) -> list[tuple]:
    def cell(value):
        if value is None or value is pd.NA or (isinstance(value, float) and value != value):
            return ""
        return f"{round(value, 6) + 0.0:.6f}" if isinstance(value, float) else str(value)

    frame = frame[sorted(frame.columns)]
    return sorted(tuple(cell(v) for v in row) for row in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf, duck, name):
    ours = entry_point.queries()[name](spark, sf).toPandas()
    theirs = duck.sql(ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert plain(ours) == plain(theirs)


@pytest.mark.parametrize("name", sorted(set(entry_point.queries()) - set(ORACLES)))
def test_query_without_sql_gives_rows(spark, sf, name):
    assert entry_point.queries()[name](spark, sf).count() > 0


def test_entry(spark):
    rows = entry_point.entry(spark)
    assert rows.columns == ["topic_id", "n_docs", "name", "aspects", "representative_docs"]
    assert rows.count() > 0

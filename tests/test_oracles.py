"""Every query with an oracle against DuckDB at the smallest scale."""

import duckdb
import pandas as pd
import pytest

from tallyweave.plans.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted((tuple(None if pd.isna(v) else v for v in r) for r in frame.itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_duckdb(spark, duck, name):
    mine, theirs = QUERIES[name](spark, SF).toPandas(), duck.sql(ORACLES[name]).df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert rows_of(mine) == rows_of(theirs)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_has_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0

"""Operators that SQL can express, against DuckDB."""

import duckdb
import pandas as pd
import pytest

from bookflow.llm import queries

SF = "/root/testdata/sf0.001"


def plain(df):
    return sorted(repr([None if pd.isna(v) else v.item() if hasattr(v, "item") else v for v in r]) for r in df[sorted(df.columns)].astype(object).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equal(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    mine, other = queries.queries()[name](spark, SF).toPandas(), con.execute(queries.oracle_sql()[name]).df()
    assert sorted(mine.columns) == sorted(other.columns)
    key = list(mine.columns)[0]
    numbers = [c for c in mine.columns if mine[c].dtype.kind in "iuf" and c != "score"]
    for df in (mine, other):
        for c in numbers:
            df[c] = df[c].astype("Float64").astype(object)
    assert plain(mine) == plain(other) and key in other

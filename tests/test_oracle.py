"""Every query that SQL can express against DuckDB, on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from bookflow.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
ORACLE = registry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(df):
    def one(v):
        if hasattr(v, "tolist"):
            v = v.tolist()
        return None if not isinstance(v, list) and pd.isna(v) else v

    return sorted(repr([one(v) for v in r]) for r in df[sorted(df.columns)].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equal(spark, duck, sf, name):
    mine, other = registry.queries()[name](spark, sf).toPandas(), duck.execute(ORACLE[name]).df()
    assert sorted(mine.columns) == sorted(other.columns)
    assert plain(mine) == plain(other)


def test_image_page_number_of_more_than_four_digits(spark, tmp_path):
    ids = [None, 0, 1, 2, 42, 9999, 10000, 10001, 10002, 99999, 100001, 1234566, 2**31 - 2, 2**31 - 1]
    spark.createDataFrame([(i,) for i in ids], "doc_id long").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    mine = registry.queries()["image_page_number"](spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.page_number) for r in mine} == set(con.execute(ORACLE["image_page_number"]).fetchall())
    assert {r.doc_id: r.page_number for r in mine}[10002] == 10002 and len(mine) == len(ids)

"""Every core query against its SQL at the smallest scale, as the driver does it."""

import duckdb
import pandas as pd
import pytest

from spantrack import queries

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted((tuple("null" if pd.isna(x) else round(float(x), 9) if isinstance(x, float) else x for x in r) for r in frame.itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", list(queries.queries()))
def test_query(spark, db, name):
    got = queries.queries()[name](spark, DATA).toPandas()
    want = db.execute(queries.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) and rows(got) == rows(want)

"""Every query with SQL gives what DuckDB gives; the others run and give rows."""

import math
import os

import duckdb
import pytest

from motionframe import plans

DIR = "/root/testdata/sf0.001"
QUERIES, SQL = plans.queries(), plans.oracle_sql()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in os.listdir(DIR):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DIR}/{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0 if v else 0.0)
    return repr(float(v)) if hasattr(v, "as_tuple") else str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, DIR)
    cols = sorted(df.columns)
    rows = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    if name not in SQL:
        assert rows
        return
    res = db.execute(SQL[name])
    names = [x[0] for x in res.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert rows == sorted(tuple(plain(r[i]) for i in at) for r in res.fetchall())

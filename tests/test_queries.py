"""Every registered query of the library that SQL can express, against its SQL on the small tables."""

import math
from decimal import Decimal

import duckdb
import pytest

from helixframe.plans.registered import QUERIES

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return con


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    plain = lambda v: None if v is None or isinstance(v, float) and math.isnan(v) else round(float(v), 4) if isinstance(v, (int, float, Decimal)) and not isinstance(v, bool) else v
    return sorted((tuple(plain(r[k]) for k in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES.sql))
def test_query_matches_sql(name, spark, con):
    df = QUERIES.queries[name](spark, DIR)
    want = con.execute(QUERIES.sql[name])
    columns = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, df.collect()) == rows(columns, want.fetchall())

"""Every registered query with SQL gives the rows that DuckDB gives on the same tables."""

import math
import os

import duckdb
import pytest

from timeweave.plans import aggregate_queries, image_queries, join_queries, rule_queries, scalar_queries, sequence_queries, signal_queries

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
MODULES = [join_queries, aggregate_queries, sequence_queries, scalar_queries, rule_queries, signal_queries, image_queries]
QUERIES = {k: q for m in MODULES for k, q in m.QUERIES.items()}
SQL = {k: q for m in MODULES for k, q in m.SQL.items()}


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5)
    return v.replace(tzinfo=None) if getattr(v, "tzinfo", None) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DIR):
        con.execute(f"create view {f.split('.')[0]} as select * from '{DIR}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DIR)
    columns = sorted(df.columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name in SQL:
        res = duck.execute(SQL[name])
        names = [c[0] for c in res.description]
        assert sorted(names) == columns
        at = [names.index(c) for c in columns]
        assert rows == sorted((tuple(plain(r[i]) for i in at) for r in res.fetchall()), key=repr)

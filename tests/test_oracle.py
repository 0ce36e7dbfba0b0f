"""Every query with SQL gives the same rows in Spark and in DuckDB."""

import math

import duckdb
import pytest

from granary.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    return str(v)


def compare(spark, sf, frame, sql):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    names = sorted(frame.columns)
    ours = sorted(tuple(norm(r[c]) for c in names) for r in frame.collect())
    got = con.execute(sql)
    columns = [d[0] for d in got.description]
    assert sorted(columns) == names
    theirs = sorted(tuple(norm(r[columns.index(c)]) for c in names) for r in got.fetchall())
    assert ours == theirs


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query(spark, sf, name):
    compare(spark, sf, catalog.queries()[name](spark, sf), catalog.oracle_sql()[name])

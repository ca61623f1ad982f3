"""Every query with an SQL text gives the same rows in DuckDB."""

import math

import duckdb
import pytest

from conftest import SMALL
from weftline.plans.registry import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


def plain(v):
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return f"{type(v).__name__}:{v}"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    relation = duck.sql(ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(relation.columns)
    at = [relation.columns.index(c) for c in columns]
    found = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    assert found == sorted(tuple(plain(r[i]) for i in at) for r in relation.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_without_sql(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0

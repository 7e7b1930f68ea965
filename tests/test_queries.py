"""Every query of the registry against its SQL in another engine."""

import os

import duckdb
import pytest

from stockyard.plans import registry

TABLES = "region nation customer supplier part orders lineitem events".split()
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{os.path.join(sf_dir, t)}.parquet'")
    return con


def test_each_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLE)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query_equals_oracle(spark, sf_dir, duck, name):
    df = registry.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    found = duck.execute(registry.ORACLE[name])
    theirs = [c[0] for c in found.description]
    assert columns == sorted(theirs)
    want = [tuple(row[theirs.index(c)] for c in columns) for row in found.fetchall()]
    got = [tuple(r[c] for c in columns) for r in df.collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    kinds = dict(duck.execute(f"SELECT column_name, column_type FROM (DESCRIBE {registry.ORACLE[name]})").fetchall())
    assert {c: KINDS.get(k, k) for c, k in df.dtypes} == kinds


def test_whole_queries_reach_every_id(spark, sf_dir, duck):
    ids = lambda sql: {r[0] for r in duck.execute(sql).fetchall()}
    got = lambda name, c: {r[0] for r in registry.QUERIES[name](spark, sf_dir).select(c).distinct().collect()}
    assert got("sku_overrides_all", "sku_id") == ids("SELECT p_partkey FROM part")
    assert got("sku_overrides_all", "level") == {"sku", "product"}
    assert got("sku_combined_all_sites", "node") == ids("SELECT s_suppkey FROM supplier")
    assert got("position_all_warehouses", "wh_id") == ids("SELECT user_id % 10 FROM events")
    assert len(got("missing_days_by_user", "user_id")) > 1

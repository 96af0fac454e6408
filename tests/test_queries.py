"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from inkloom.plans import registry

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables here")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return c


def plain(x):
    return round(x, 6) if isinstance(x, float) else tuple(map(plain, x)) if isinstance(x, (list, tuple)) else x


def compare(spark, duck, name, queries, oracles):
    df = queries[name](spark, DIR)
    columns = sorted(df.columns)
    found = sorted(repr([plain(r[c]) for c in columns]) for r in df.collect())
    if name not in oracles:
        assert found
        return
    result = duck.execute(oracles[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    assert found == sorted(repr([plain(r[names.index(c)]) for c in columns]) for r in result.fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - {"approximate_pairs"}))
def test_query(spark, duck, name):
    compare(spark, duck, name, registry.QUERIES, registry.ORACLES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(registry.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())

"""Every registered query that does not need a store, against its SQL twin on the smallest data."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from workloads.oracles import ORACLES

DATA = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
SLOW = ("published", "imported", "monitored_of", "synced", "warehouse", "exported", "streamed")
QUICK = sorted(n for n in ORACLES if not n.startswith(SLOW))

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"create view {name} as select * from '{DATA}/{name}.parquet'")
    return con


def plain(rows):
    cell = lambda v: float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v
    return sorted((tuple(map(cell, r)) for r in rows), key=str)


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_its_sql(spark, duck, name):
    df, other = entry.queries()[name](spark, DATA), duck.sql(ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(other.columns)
    order = [other.columns.index(c) for c in columns]
    got = plain(df.select(*columns).collect())
    assert got == plain([r[i] for i in order] for r in other.fetchall())


def test_the_flagship_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_names_a_query():
    assert set(ORACLES) <= set(entry.queries())

"""The registered queries on the smallest given tables, against SQL where there is some; the pipeline."""

import os

import duckdb
import pytest

import corpus_pipeline
from quayside.llm.oracles import ORACLES
from quayside.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the test tables are not here")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels"):
        con.sql(f"create view {table} as select * from '{DATA}/{table}.parquet'")
    df, other = QUERIES[name](spark, DATA), con.sql(ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(other.columns)
    cell = lambda v: round(v, 9) if isinstance(v, float) else v
    plain = lambda rows: sorted((tuple(map(cell, r)) for r in rows), key=str)
    order = [other.columns.index(c) for c in columns]
    assert plain(df.select(*columns).collect()) == plain([r[i] for i in order] for r in other.fetchall())


def test_pipeline_stages_hand_on_documents(spark, folder):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, DATA)
        path = folder(f"stage{k}")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        counts.append(docs.count())
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns, name
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0
    assert counts[-1] == counts[-2]

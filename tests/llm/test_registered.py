"""The registered queries and the pipeline on the smallest data."""

import duckdb
import pytest

import corpus_pipeline
from riskframe.llm import queries
from riskframe.llm.common import stage

DATA = "/root/testdata/sf0.001"
ROWS = {1: "documents", 2: "pages", 5: "documents", 6: "documents", 7: "documents", 8: "documents", 9: "pages", 10: "documents", 12: "documents", 13: "documents"}


@pytest.mark.parametrize("name", queries.QUERIES)
def test_query_covers_its_table(spark, name):
    rows = queries.QUERIES[name](spark, DATA)
    n = int(name[2:].split("_")[0])
    if n in ROWS:
        whole = spark.read.parquet(f"{DATA}/{ROWS[n]}.parquet").count()
        extra = spark.read.parquet(f"{DATA}/pages.parquet").count() if n == 1 else 0
        assert rows.count() == whole + extra
    else:
        assert rows.count() > 0


@pytest.mark.parametrize("name", queries.ORACLE)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    want = con.execute(queries.ORACLE[name])
    columns = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, DATA).select(*columns).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want.fetchall(), key=str)


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, last = docs.columns, len(corpus_pipeline.STAGES) - 1
    counts = []
    for k, (_, step) in enumerate(corpus_pipeline.STAGES):
        docs = stage(step(spark, docs, DATA), "stage")
        counts.append(docs.count())
        assert k == last or docs.columns == columns
    assert spark.read.parquet(f"{DATA}/documents.parquet").count() > counts[0] > counts[1] == counts[2]
    assert corpus_pipeline.run(spark, DATA).count() == counts[-1]

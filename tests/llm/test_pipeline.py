"""The pipeline's stages one after the other, and the registered text queries."""

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from check_oracles import canonical, fetched

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF).cache()
        assert out.columns == docs.columns, name
        now = {r.doc_id for r in out.select("doc_id").collect()}
        assert now <= seen and len(now) >= 0.6 * len(seen), name
        docs, seen = out, now
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).select("doc_id").distinct().count()
    assert pieces == len(seen)


def test_stages_take_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_thirteen_queries_and_the_pipeline_are_registered():
    names = contract.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names


@pytest.mark.parametrize("name", [n for n in contract.oracle_sql() if n.startswith("op") and n[2].isdigit()])
def test_check_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    assert canonical(fetched(contract.queries()[name](spark, SF))) == canonical(con.execute(contract.oracle_sql()[name]).df())

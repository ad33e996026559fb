"""The registered training-data queries on the smallest driver tables."""

import pytest

import __spark_entry__ as entry
from martlet.llm.queries import ORACLE, QUERIES
from martlet.verify.compare import compare, duckdb_connection

from conftest import SMALL


def test_all_operators_and_the_pipeline_are_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, name):
    got = compare(QUERIES[name](spark, SMALL), duckdb_connection(SMALL), ORACLE[name])
    assert got["columns_match"] and got["values_match"], got


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_returns_a_row_per_document(spark, name):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = QUERIES[name](spark, SMALL)
    assert sorted(r[0] for r in got.select("doc_id").collect()) == sorted(r[0] for r in docs.select("doc_id").collect())

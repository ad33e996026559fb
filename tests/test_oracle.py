"""Every registered query equals its DuckDB oracle on the smallest driver tables."""

import pytest

import __spark_entry__ as entry
from martlet.catalog import REGISTRY
from martlet.verify.compare import compare, duckdb_connection

from conftest import SMALL

#: The training-data queries have their own tests, beside their subpackage.
NAMES = sorted(REGISTRY)


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SMALL)


def test_every_query_has_oracle_sql():
    assert set(NAMES) <= set(entry.oracle_sql()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(entry.queries()[name](spark, SMALL), con, entry.oracle_sql()[name])
    assert res["columns_match"] and res["values_match"], res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "order_date" in df.columns


def test_entry_schema_is_stable(spark):
    first, second = entry.entry(spark), entry.entry(spark)
    assert first.schema == second.schema and first.count() == second.count()
    assert first.columns[:2] == ["order_date", "source_batch_id"]
    assert dict(first.dtypes)["ordered_item_amount"] == "decimal(28,4)"


def test_every_query_takes_spark_and_sf_dir():
    import inspect
    for name, fn in entry.queries().items():
        assert len(inspect.signature(fn).parameters) == 2, name

"""Plan-level guards for the scale rules, over every registered query."""

import pytest

import __spark_entry__ as entry
from martlet.catalog import REGISTRY

from conftest import SMALL

# Queries whose construction lands or exports data (they run jobs when built).
SIDE_EFFECTS = ("land_rowcount_guard", "land_idempotent_append", "land_stream_metrics", "land_batch_append",
                "land_aligned_append",
                "export_daily_mart", "export_verify", "export_fingerprint")
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in REGISTRY if n not in SIDE_EFFECTS))
def test_no_cartesian_nested_loop_or_python(spark, name):
    plan = _plan(entry.queries()[name](spark, SMALL))
    assert not [w for w in FORBIDDEN if w in plan], plan


@pytest.mark.parametrize("name", ["stg_orders", "stg_order_items", "stg_events", "stg_users"])
def test_staging_prunes_partitions_and_columns(spark, name):
    df = entry.queries()[name](spark, SMALL)
    formatted = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters: [isnotnull(_BATCH_ID" in formatted and "= 20260101T000000Z" in formatted
    assert "ReadSchema: struct<" in formatted

"""The daily mart equals a brute-force Python aggregation of random fact rows."""

import datetime as dt
from collections import defaultdict
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from martlet.plans.marts import MONEY_MEASURES, mart_daily_sales

STATUSES = ["complete", "cancelled", "returned", "shipped", "processing", "lost"]
money = st.one_of(st.none(), st.decimals(min_value=-1000, max_value=1000, places=4, allow_nan=False))
fact_row = st.tuples(
    st.one_of(st.none(), st.sampled_from([dt.date(2020, 1, 1), dt.date(2020, 1, 2)])),
    st.integers(0, 4), st.one_of(st.none(), st.integers(0, 3)), st.sampled_from(STATUSES),
    money, money, st.one_of(st.none(), st.booleans()))
SCHEMA = ("order_date date, order_id long, customer_id long, order_item_status string, item_amount decimal(18,4), "
          "unit_cost decimal(18,4), is_created_after_extract boolean")


def _fact(spark, rows):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, SCHEMA)
    s = F.col("order_item_status")
    return df.select(
        "*", F.lit("B").alias("source_batch_id"), F.lit(1).cast("bigint").alias("item_quantity"),
        F.when(s == "complete", F.col("item_amount")).otherwise(0).cast("decimal(18,4)").alias("completed_sales_amount"),
        F.when(s == "complete", F.col("unit_cost")).otherwise(0).cast("decimal(18,4)").alias("completed_cost_amount"),
        F.when(s == "complete", F.col("item_amount") - F.col("unit_cost")).otherwise(0).cast("decimal(18,4)")
        .alias("completed_gross_margin_amount"),
        F.when(s == "cancelled", F.col("item_amount")).otherwise(0).cast("decimal(18,4)").alias("cancelled_item_amount"),
        F.when(s == "returned", F.col("item_amount")).otherwise(0).cast("decimal(18,4)").alias("returned_item_amount"))


def _sum(values):
    vals = [v for v in values if v is not None]
    return sum(vals, Decimal(0)) if vals else None


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(fact_row, min_size=1, max_size=30))
def test_mart_matches_brute_force(spark, rows):
    fact = _fact(spark, rows)
    got = {r.order_date: r.asDict() for r in mart_daily_sales(fact).collect()}
    facts = [r.asDict() for r in fact.collect()]
    groups = defaultdict(list)
    for f in facts:
        groups[f["order_date"]].append(f)
    assert set(got) == set(groups)                         # NULL date is its own group
    for day, fs in groups.items():
        g = got[day]
        assert g["order_count"] == len({f["order_id"] for f in fs})
        assert g["customer_count"] == len({f["customer_id"] for f in fs if f["customer_id"] is not None})
        assert g["item_count"] == len(fs)
        for status, name in [("complete", "completed"), ("cancelled", "cancelled"), ("returned", "returned"),
                             ("shipped", "shipped"), ("processing", "processing")]:
            assert g[f"{name}_item_count"] == sum(f["order_item_status"] == status for f in fs)
        for src, dst in MONEY_MEASURES:
            assert g[dst] == _sum(f[src] for f in fs), (dst, day)
        assert g["future_created_item_count"] == sum(1 for f in fs if f["is_created_after_extract"])

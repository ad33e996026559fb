"""Hot keys: one order holding a third of all rows."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from martlet.plans.batch_build import build
from martlet.sources.driver_tables import ITEM_ORDER, item_lines
from martlet.sources.landing import stamp_batch

B = "20260101T000000Z"


@pytest.fixture
def skew_conf(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _skewed_lineitem(spark, path):
    rows = []
    for i in range(3000):
        order = 7 if i < 1000 else 100 + i // 4             # order 7 holds a third of the rows
        rows.append((order, i % 50, i % 13, i % 7 + 1, float(i), 0.05, "N", "F",
                     dt.datetime(1996, 1, 1) + dt.timedelta(days=i % 300)))
    df = spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                                     "l_extendedprice double, l_discount double, l_returnflag string, "
                                     "l_linestatus string, l_shipdate timestamp_ntz")
    df.repartition(4).write.parquet(f"{path}/lineitem.parquet")
    return rows


def test_item_ids_are_global_ranks_and_spread_a_hot_order(spark, skew_conf):
    # Coalescing is off here: at 3,000 rows AQE would rightly merge every range into one task.
    d = tempfile.mkdtemp(prefix="martlet-skew-")
    rows = _skewed_lineitem(spark, d)
    lines = item_lines(spark, d)
    got = {(r.l_orderkey, r.l_linenumber, r.l_partkey, r.l_suppkey, r.l_extendedprice): r.item_id
           for r in lines.collect()}
    ordered = sorted((r[0], r[3], r[1], r[2], r[4]) for r in rows)
    assert got == {key: i + 1 for i, key in enumerate(ordered)}      # exact rank, unique, no gaps
    spread = (lines.filter(F.col("l_orderkey") == 7).select(F.spark_partition_id().alias("p"))
              .distinct().count())
    assert spread > 1                                                # the hot order is not one task
    assert tuple(ITEM_ORDER)[0] == "l_orderkey"


def test_fact_join_splits_the_hot_order(spark, skew_conf):
    x = dt.datetime(2030, 1, 1, tzinfo=dt.timezone.utc)
    items = spark.range(20000).select(
        F.col("id"), F.when(F.col("id") < 7000, F.lit(1)).otherwise(F.col("id") % 500 + 2).alias("order_id"),
        F.lit(5).cast("long").alias("user_id"), F.lit(3).cast("long").alias("product_id"),
        F.col("id").alias("inventory_item_id"), F.lit("Complete").alias("status"),
        F.lit(dt.datetime(2020, 1, 1)).cast("timestamp").alias("created_at"),
        *[F.lit(None).cast("timestamp").alias(c) for c in ("shipped_at", "delivered_at", "returned_at")],
        (F.col("id") % 100).cast("double").alias("sale_price"))
    orders = spark.range(502).select(
        F.col("id").alias("order_id"), F.lit(5).cast("long").alias("user_id"), F.lit("Complete").alias("status"),
        F.lit("F").alias("gender"), F.lit(dt.datetime(2020, 1, 2)).cast("timestamp").alias("created_at"),
        *[F.lit(None).cast("timestamp").alias(c) for c in ("returned_at", "shipped_at", "delivered_at")],
        F.lit(1).cast("long").alias("num_of_item"))
    inv = spark.range(20000).select(F.col("id"), F.lit(3).cast("long").alias("product_id"),
                                    *[F.lit(None).cast("timestamp").alias(c) for c in ("created_at", "sold_at")],
                                    F.lit(1.5).alias("cost"),
                                    *[F.lit(None).cast("string").alias(c) for c in (
                                        "product_category", "product_name", "product_brand",
                                        "product_department", "product_sku")],
                                    F.lit(1.0).alias("product_retail_price"),
                                    F.lit(1).cast("long").alias("product_distribution_center_id"))
    raw = {"order_items": stamp_batch(items, B, x), "orders": stamp_batch(orders, B, x),
           "inventory_items": stamp_batch(inv, B, x)}
    fct = build(raw, B).fct_order_items
    assert fct.count() == 20000                                      # whole result, nothing dropped
    assert fct.filter(F.col("order_date").isNull()).count() == 0
    assert len(fct.collect()) == 20000                                 # runs this DataFrame's own plan
    final = fct._jdf.queryExecution().executedPlan().toString()      # the final adaptive plan
    assert "skew=true" in final                                      # AQE split the hot order's partition


def test_fact_reconciliation_splits_a_fanned_out_key(spark, skew_conf):
    from decimal import Decimal

    from martlet.operators import reconcile
    x = dt.datetime(2030, 1, 1, tzinfo=dt.timezone.utc)
    items = spark.range(4000).select(
        F.col("id"), (F.col("id") % 300).alias("order_id"), F.lit(5).cast("long").alias("user_id"),
        F.lit(3).cast("long").alias("product_id"), F.col("id").alias("inventory_item_id"),
        F.lit("Complete").alias("status"), F.lit(dt.datetime(2020, 1, 1)).cast("timestamp").alias("created_at"),
        *[F.lit(None).cast("timestamp").alias(c) for c in ("shipped_at", "delivered_at", "returned_at")],
        F.lit(10.0).alias("sale_price"))
    orders = spark.range(300).select(
        F.col("id").alias("order_id"), F.lit(5).cast("long").alias("user_id"), F.lit("Complete").alias("status"),
        F.lit("F").alias("gender"), F.lit(dt.datetime(2020, 1, 2)).cast("timestamp").alias("created_at"),
        *[F.lit(None).cast("timestamp").alias(c) for c in ("returned_at", "shipped_at", "delivered_at")],
        F.lit(1).cast("long").alias("num_of_item"))
    inv = spark.range(4000).select(
        F.col("id"), F.lit(3).cast("long").alias("product_id"),
        *[F.lit(None).cast("timestamp").alias(c) for c in ("created_at", "sold_at")], F.lit(1.5).alias("cost"),
        *[F.lit(None).cast("string").alias(c) for c in ("product_category", "product_name", "product_brand",
                                                        "product_department", "product_sku")],
        F.lit(1.0).alias("product_retail_price"), F.lit(1).cast("long").alias("product_distribution_center_id"))
    raw = {"order_items": stamp_batch(items, B, x), "orders": stamp_batch(orders, B, x),
           "inventory_items": stamp_batch(inv, B, x)}
    b = build(raw, B)
    fct = b.fct_order_items
    # 5,000 copies of item 42, each with a different wrong cost (distinct rows, so the
    # shuffle does not compress them away and AQE sees the skew by size)
    hot = (fct.filter(F.col("order_item_id") == 42)
           .crossJoin(spark.range(5000).withColumnRenamed("id", "_copy"))      # test fixture only
           .withColumn("unit_cost", (F.lit(Decimal("9.0000")) + F.col("_copy") / 10000).cast("decimal(18,4)"))
           .drop("_copy"))
    tampered = fct.filter(F.col("order_item_id") != 42).unionByName(hot)
    s = b.staged
    out = reconcile.fact_reconciliation(tampered, s["stg_order_items"], s["stg_orders"], s["stg_inventory_items"])
    rows = out.collect()
    assert len(rows) == 5000 and {r.order_item_id for r in rows} == {42}     # every fanned-out row reported
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()

"""What steps leave on disk while a query runs: shuffles go with their action, tables between joins with the next table."""

import os
import random
import tempfile
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martlet import catalog
from martlet.functions.money import MONEY, iff_money
from martlet.functions.predicates import any_distinct
from martlet.operators import reconcile
from martlet.plans import incremental, marts
from martlet.plans.batch_build import Build
from martlet.session import PARTITION_BYTES, configure, size_shuffles

import test_incremental as inc

B = "20260101T000000Z"
INSTANT = datetime(2026, 1, 1)


def test_shuffle_files_are_to_go_with_their_action(spark):
    configure(spark)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
    rows = spark.range(10_000).repartition(7, "id").groupBy((F.col("id") % 100).alias("k")).count()
    assert len(rows.collect()) == len(rows.collect()) == rows.count() == 100  # a DataFrame can be used again


def test_shuffles_begin_with_partitions_in_proportion_to_the_tables(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        size_shuffles(spark, 1)
        assert int(spark.conf.get(key)) == least
        size_shuffles(spark, PARTITION_BYTES * (least + 5) + 1)
        assert int(spark.conf.get(key)) == least + 6
    finally:
        spark.conf.unset(key)


def staged(spark, seed):
    """Items, orders and units with null and repeated keys."""
    rnd = random.Random(seed)
    key = lambda n: rnd.choice([None, *range(n)])
    items = [(key(40), key(12), key(3), key(3), key(20), rnd.choice(["complete", "cancelled", "returned", None]), INSTANT, None, None, None,
              rnd.choice([None, 1.0, 2.5]), B, INSTANT, False) for _ in range(60)]
    orders = [(key(12), key(3), rnd.choice([None, INSTANT, datetime(2025, 5, 1)]), B) for _ in range(14)]
    units = [(key(20), key(3), rnd.choice([None, 0.5, 1.5]), B) for _ in range(22)]
    return (spark.createDataFrame(items, inc.ITEMS), spark.createDataFrame(orders, inc.ORDERS),
            spark.createDataFrame(units, "inventory_item_id long, product_id long, cost double, source_batch_id string"))


def test_written_fact_is_the_fact_and_leaves_no_table_between(spark):
    items, orders, units = staged(spark, 1)
    b, root = Build({}, B), tempfile.mkdtemp(prefix="martlet-fact-")
    b._staged = {"stg_order_items": items, "stg_orders": orders, "stg_inventory_items": units}
    got = catalog._written_fact(spark, b, root)
    want = marts.fct_order_items(items, orders, units)
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert os.listdir(root) == ["fct_order_items"]


def whole_reconciliation(fct, items, orders, units):
    """All terms at once, after a full outer join."""
    side = lambda df, p: df.select(*[F.col(c).alias(f"{p}_{c}") for c in df.columns])
    f, s, o, i = side(fct, "f"), side(items, "s"), side(orders, "o"), side(units, "i")
    j = (f.join(s, F.col("f_order_item_id") == F.col("s_order_item_id"), "full").join(o, F.col("s_order_id") == F.col("o_order_id"), "left")
         .join(i, F.col("s_inventory_item_id") == F.col("i_inventory_item_id"), "left"))
    c = F.col
    price, cost, status = c("s_sale_price").cast(MONEY), c("i_cost").cast(MONEY), c("s_order_item_status")
    same = [(c(f"f_{n}"), c(f"s_{n}")) for n in ("order_id", "customer_id", "product_id", "inventory_item_id", "order_item_status", "source_batch_id")]
    bad = any_distinct([*same, (c("f_item_amount"), price), (c("f_unit_cost"), cost), (c("f_order_date"), c("o_created_at").cast("date")),
                        (c("f_source_batch_id"), c("o_source_batch_id")), (c("f_source_batch_id"), c("i_source_batch_id")), (c("f_customer_id"), c("o_customer_id")),
                        (c("f_product_id"), c("i_product_id")), (c("f_completed_sales_amount"), iff_money(status == "complete", price)),
                        (c("f_completed_cost_amount"), iff_money(status == "complete", cost)), (c("f_cancelled_item_amount"), iff_money(status == "cancelled", price)),
                        (c("f_returned_item_amount"), iff_money(status == "returned", price))],
                       extra=[c("f_order_item_id").isNull(), c("s_order_item_id").isNull(),
                              c("f_completed_gross_margin_amount") != c("f_completed_sales_amount") - c("f_completed_cost_amount")])
    return j.filter(bad).select(F.coalesce("f_order_item_id", "s_order_item_id").alias("order_item_id"))


@pytest.mark.parametrize("seed", [2, 3])
def test_terms_judged_early_report_the_same_rows(spark, seed):
    items, orders, units = staged(spark, seed)
    fct = marts.fct_order_items(items, orders, units)
    k = F.col("order_item_id")
    tampered = (fct.filter((k % 9 != 2) | k.isNull())
                .withColumn("order_date", F.when(k % 7 == 1, F.lit(date(2020, 1, 1))).otherwise(F.col("order_date")))
                .withColumn("unit_cost", F.when(k % 11 == 1, F.lit(Decimal("9.0000")).cast(MONEY)).otherwise(F.col("unit_cost")))
                .withColumn("completed_gross_margin_amount", F.when(k % 5 == 1, F.lit(None).cast(MONEY)).otherwise(F.col("completed_gross_margin_amount"))))
    halves = []
    got = reconcile.fact_reconciliation(tampered, items, orders, units, lambda half: halves.append(half.columns) or half)
    assert sorted(map(str, got.collect())) == sorted(map(str, whole_reconciliation(tampered, items, orders, units).collect()))
    assert [len(h) for h in halves] == [11, 4]  # of 23 and 14 columns


def test_a_run_keeps_only_the_tables_that_it_still_needs(spark, monkeypatch):
    root, upto = tempfile.mkdtemp(prefix="martlet-incremental-"), inc.batch(spark, random.Random(3), inc.BATCHES[0])

    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(incremental, "_replace_parts", stop)
        with pytest.raises(RuntimeError, match="stopped"):
            incremental.apply_batch(spark, root, upto, inc.BATCHES[0])
    assert sorted(os.listdir(f"{root}/_runs/{inc.BATCHES[0]}")) == ["daily", "gone", "parts", "rows", "touched"]
    assert incremental.apply_batch(spark, root, upto, inc.BATCHES[0])
    inc.same(spark, root, upto)

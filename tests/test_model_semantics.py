"""Edge cases of the staging -> fact -> mart semantics on tiny RAW fixtures."""

from datetime import datetime, timezone
from decimal import Decimal

from pyspark.sql import functions as F

from martlet.operators import reconcile
from martlet.plans import marts
from martlet.plans.batch_build import build
from martlet.sources.landing import stamp_batch

B = "20260101T000000Z"
UTC = timezone.utc


def _raw(spark):
    items = spark.createDataFrame(
        [(1, 10, 7, 100, 1, "Complete", datetime(2020, 1, 1, 23, 0, tzinfo=UTC), 10.0),
         (2, 10, 7, 101, 2, "Returned", datetime(2020, 1, 2, 1, 0, tzinfo=UTC), 5.25),
         (3, 11, 8, 100, 3, "Cancelled", datetime(2030, 1, 1, tzinfo=UTC), 7.0),
         (4, 99, 8, 100, 99, "complete", None, 1.0)],  # parent order and inventory missing
        "id long, order_id long, user_id long, product_id long, inventory_item_id long, status string, "
        "created_at timestamp, sale_price double")
    for c in ("shipped_at", "delivered_at", "returned_at"):
        items = items.withColumn(c, F.lit(None).cast("timestamp"))
    orders = spark.createDataFrame(
        [(10, 7, "Complete", datetime(2020, 1, 1, 23, 30, tzinfo=UTC), 2),
         (11, 8, "Processing", datetime(2020, 1, 3, 0, 0, tzinfo=UTC), None)],
        "order_id long, user_id long, status string, created_at timestamp, num_of_item long")
    for c in ("returned_at", "shipped_at", "delivered_at"):
        orders = orders.withColumn(c, F.lit(None).cast("timestamp"))
    orders = orders.withColumn("gender", F.lit("F"))
    inv = spark.createDataFrame([(1, 100, 4.12345), (2, 101, 2.0), (3, 100, 3.0)], "id long, product_id long, cost double")
    for c in ("created_at", "sold_at"):
        inv = inv.withColumn(c, F.lit(None).cast("timestamp"))
    for c in ("product_category", "product_name", "product_brand", "product_department", "product_sku"):
        inv = inv.withColumn(c, F.lit(None).cast("string"))
    inv = inv.withColumn("product_retail_price", F.lit(1.0)).withColumn("product_distribution_center_id", F.lit(1))
    x = datetime(2025, 1, 1, tzinfo=UTC)
    return {"order_items": stamp_batch(items, B, x), "orders": stamp_batch(orders, B, x),
            "inventory_items": stamp_batch(inv, B, x)}


def test_fact_grain_dates_and_money(spark):
    b = build(_raw(spark), B)
    f = {r.order_item_id: r for r in b.fct_order_items.collect()}
    assert len(f) == 4                                              # left joins keep every item
    assert str(f[1].order_date) == "2020-01-01" and str(f[2].order_date) == "2020-01-01"  # parent order's day
    assert f[4].order_date is None and f[4].unit_cost is None       # missing parents stay NULL
    assert f[1].unit_cost == Decimal("4.1235")                      # half-up at 4 places
    assert f[1].completed_gross_margin_amount == Decimal("5.8765")
    assert f[2].returned_item_amount == Decimal("5.2500") and f[2].completed_sales_amount == Decimal("0.0000")
    assert f[3].is_created_after_extract is True and f[4].is_created_after_extract is None
    assert f[4].order_item_status == "complete" and f[4].completed_cost_amount is None  # true cond, NULL value


def test_mart_null_date_group_is_reported_by_reconciliation(spark):
    b = build(_raw(spark), B)
    mart = {str(r.order_date): r for r in b.mart_daily_sales.collect()}
    assert set(mart) == {"2020-01-01", "2020-01-03", "None"}        # NULL date forms its own group, no spine
    assert mart["2020-01-01"].order_count == 1 and mart["2020-01-01"].item_count == 2
    assert mart["2020-01-03"].future_created_item_count == 1
    s = b.staged
    expected = reconcile.daily_expected(s["stg_order_items"], s["stg_orders"], s["stg_inventory_items"])
    bad = [str(r.order_date) for r in reconcile.daily_reconciliation(expected, b.mart_daily_sales).collect()]
    assert bad == ["None"]                                          # NULL = NULL never matches


def test_declared_item_count_null_is_a_violation(spark):
    b = build(_raw(spark), B)
    bad = sorted(r.order_id for r in reconcile.order_quantities(b.staged["stg_orders"], b.fct_order_items).collect())
    assert bad == [11]          # order 10 declares 2 and has 2; order 11 declares NULL


def test_fact_reconciliation_margin_uses_plain_inequality(spark):
    b = build(_raw(spark), B)
    s = b.staged
    clean = reconcile.fact_reconciliation(b.fct_order_items, s["stg_order_items"], s["stg_orders"],
                                          s["stg_inventory_items"])
    # Item 4 has no parent order or inventory unit: batch ids compare with NULL.
    assert sorted(r.order_item_id for r in clean.collect()) == [4]
    tampered = b.fct_order_items.withColumn(
        "completed_gross_margin_amount",
        F.when(F.col("order_item_id") == 1, F.lit(Decimal("0.0001")).cast("decimal(18,4)"))
        .when(F.col("order_item_id") == 2, F.lit(None).cast("decimal(18,4)"))
        .otherwise(F.col("completed_gross_margin_amount")))
    bad = reconcile.fact_reconciliation(tampered, s["stg_order_items"], s["stg_orders"], s["stg_inventory_items"])
    # Item 1's wrong margin is caught; item 2's NULL margin passes the plain ``<>`` identity.
    assert sorted(r.order_item_id for r in bad.collect()) == [1, 4]


def test_kpis_recount_buyers(spark):
    k = marts.sales_kpis(build(_raw(spark), B).fct_order_items).first()
    assert (k.item_count, k.order_count, k.buyer_count) == (4, 3, 2)


def test_dimension_coverage_uses_set_semantics(spark):
    users = spark.createDataFrame([(1,), (None,), (2,)], "customer_id long")
    products = spark.createDataFrame([(7,)], "product_id long")
    same = reconcile.dimension_coverage(users, users, products, products)
    assert same.count() == 0                                   # NULL key on both sides is covered
    missing_null = reconcile.dimension_coverage(users, users.filter("customer_id IS NOT NULL"), products, products)
    assert [r.entity for r in missing_null.collect()] == ["customers"]
    duplicated = reconcile.dimension_coverage(users, users, products, products.union(products))
    assert [r.entity for r in duplicated.collect()] == ["products"]   # counts differ, keys covered

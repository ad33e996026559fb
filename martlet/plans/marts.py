"""Star-schema marts built from the staging DataFrames.

``fct_order_items``: one row per staged order item; left joins to the parent
order and the linked inventory unit on (id, batch) keep the grain. The order
date is the *parent order's* UTC date, so an order falls on one day.

``mart_daily_sales``: one row per (order date, batch). The two exact distinct
counts are planned by Catalyst as an ``Expand`` + two-level aggregate: the
first level is keyed by (day, batch, distinct key), so a heavy day is spread
over many tasks and only partial counts are shuffled by day.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.config import STATUS_COLUMN_NAMES
from martlet.functions.money import MONEY, iff_money, money


def dim_customers(stg_users: DataFrame) -> DataFrame:
    """Selected-snapshot users, including non-buyers; no email or street address."""
    return stg_users.select(
        "customer_id", "first_name", "last_name", "age", "gender", "city", "state", "country",
        F.col("traffic_source").alias("acquisition_channel"),
        F.col("created_at").alias("registered_at"),
        "source_batch_id", "extracted_at")


def dim_products(stg_products: DataFrame) -> DataFrame:
    """Selected-snapshot products with catalog money as DECIMAL(18,4)."""
    return stg_products.select(
        "product_id", "product_name", "brand", "category", "department", "sku",
        money("retail_price").alias("current_retail_price"),
        money("cost").alias("current_unit_cost"),
        "distribution_center_id", "source_batch_id", "extracted_at")


def fct_order_items(stg_order_items: DataFrame, stg_orders: DataFrame, stg_inventory_items: DataFrame,
                    stored: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """``stored`` may put the items with their costs into a table, so the first join's shuffles are gone before the second's are made."""
    orders = stg_orders.select("order_id", "source_batch_id", F.col("created_at").alias("order_created_at"))
    inventory = stg_inventory_items.select("inventory_item_id", "source_batch_id",
                                           F.col("cost").alias("inventory_cost"))
    # orders last: an order's items are then written together, and counts of distinct orders and buyers combine map-side
    priced = stored(stg_order_items.join(inventory, ["inventory_item_id", "source_batch_id"], "left"))
    return fact_columns(priced.join(orders, ["order_id", "source_batch_id"], "left"))


def fact_columns(joined: DataFrame) -> DataFrame:
    """The fact's columns from order items with their order's instant and inventory cost."""
    status = F.col("order_item_status")
    item_amount = money("sale_price")
    unit_cost = money("inventory_cost")
    return joined.select(
        "order_item_id", "order_id", "customer_id", "product_id", "inventory_item_id",
        "order_created_at",
        F.col("order_created_at").cast("date").alias("order_date"),
        F.col("created_at").alias("item_created_at"),
        "shipped_at", "delivered_at", "returned_at",
        "order_item_status",
        F.lit(1).cast("bigint").alias("item_quantity"),
        item_amount.alias("item_amount"),
        unit_cost.alias("unit_cost"),
        iff_money(status == "complete", item_amount).alias("completed_sales_amount"),
        iff_money(status == "complete", unit_cost).alias("completed_cost_amount"),
        iff_money(status == "complete", item_amount - unit_cost).alias("completed_gross_margin_amount"),
        iff_money(status == "cancelled", item_amount).alias("cancelled_item_amount"),
        iff_money(status == "returned", item_amount).alias("returned_item_amount"),
        "is_created_after_extract", "source_batch_id", "extracted_at")


MONEY_MEASURES = (
    ("item_amount", "ordered_item_amount"),
    ("completed_sales_amount", "completed_sales_amount"),
    ("completed_cost_amount", "completed_cost_amount"),
    ("completed_gross_margin_amount", "completed_gross_margin_amount"),
    ("cancelled_item_amount", "cancelled_item_amount"),
    ("returned_item_amount", "returned_item_amount"),
)


def mart_daily_sales(fct: DataFrame) -> DataFrame:
    """Daily order-cohort summary; days without orders are absent (no date spine)."""
    status = F.col("order_item_status")
    status_counts = [F.sum(F.when(status == s, 1).otherwise(0)).alias(f"{name}_item_count")
                     for s, name in STATUS_COLUMN_NAMES.items()]
    sums = [F.sum(src).alias(dst) for src, dst in MONEY_MEASURES]
    return fct.groupBy("order_date", "source_batch_id").agg(
        F.count_distinct("order_id").alias("order_count"),
        F.count_distinct("customer_id").alias("customer_count"),
        F.sum("item_quantity").alias("item_count"),
        *status_counts,
        *sums,
        F.sum(F.when(F.col("is_created_after_extract"), 1).otherwise(0)).alias("future_created_item_count"))


def sales_kpis(fct: DataFrame) -> DataFrame:
    """Whole-period KPI row; buyers are re-counted from the fact (not additive by day)."""
    return fct.agg(
        F.count(F.lit(1)).alias("item_count"),
        F.count_distinct("order_id").alias("order_count"),
        F.count_distinct("customer_id").alias("buyer_count"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        *[F.sum(src).alias(dst) for src, dst in MONEY_MEASURES])


def latest_order_dates(mart: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most recent order dates (top-k: one bounded heap per task)."""
    return mart.select("order_date").orderBy(F.col("order_date").desc()).limit(n)


__all__ = ["MONEY", "dim_customers", "dim_products", "fct_order_items", "mart_daily_sales",
           "sales_kpis", "latest_order_dates"]

"""Staging: one lazily evaluated DataFrame per RAW table for one selected batch.

Same grain as the source (no joins, no dedup), descriptive key names, fixed
types, UTC ``TIMESTAMP_NTZ`` timestamps, lower-cased statuses, lineage
columns, and ``is_created_after_extract`` computed from the RAW tz-aware
instants *before* conversion. The batch filter is the first operator, so it
becomes a partition filter on a partitioned RAW table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.config import BATCH_COL, EXTRACTED_COL
from martlet.functions.batch_ids import require_batch_id
from martlet.functions.temporal import utc_ntz
from martlet.session import assert_utc


def select_batch(raw: DataFrame, batch_id: str) -> DataFrame:
    """``where _batch_id = '<id>'`` with the id validated first."""
    require_batch_id(batch_id)
    assert_utc(raw.sparkSession)
    return raw.filter(F.col(BATCH_COL) == F.lit(batch_id))


def _id(name: str) -> Column:
    return F.col(name).cast("bigint")


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _float(name: str) -> Column:
    return F.col(name).cast("double")


def _ts(name: str) -> Column:
    return utc_ntz(F.col(name))


def _lineage(batch_id: str, with_flag: bool = True) -> list[Column]:
    # the batch filter leaves one id; as a constant it need not go through joins and shuffles
    cols = [F.lit(batch_id).alias("source_batch_id"), _ts(EXTRACTED_COL).alias("extracted_at")]
    if with_flag:
        cols.append((F.col("created_at") > F.col(EXTRACTED_COL)).alias("is_created_after_extract"))
    return cols


def stg_distribution_centers(raw: DataFrame, batch_id: str) -> DataFrame:
    return select_batch(raw, batch_id).select(
        _id("id").alias("distribution_center_id"),
        _text("name").alias("distribution_center_name"),
        _float("latitude").alias("latitude"),
        _float("longitude").alias("longitude"),
        _text("distribution_center_geom").alias("distribution_center_geom"),
        *_lineage(batch_id, with_flag=False))


def stg_events(raw: DataFrame, batch_id: str) -> DataFrame:
    return select_batch(raw, batch_id).select(
        _id("id").alias("event_id"),
        _id("user_id").alias("customer_id"),
        _id("sequence_number").alias("sequence_number"),
        _text("session_id").alias("session_id"),
        _ts("created_at").alias("created_at"),
        _text("ip_address").alias("ip_address"),
        _text("city").alias("city"),
        _text("state").alias("state"),
        _text("postal_code").alias("postal_code"),
        _text("browser").alias("browser"),
        _text("traffic_source").alias("traffic_source"),
        _text("uri").alias("uri"),
        _text("event_type").alias("event_type"),
        *_lineage(batch_id))


def stg_inventory_items(raw: DataFrame, batch_id: str) -> DataFrame:
    return select_batch(raw, batch_id).select(
        _id("id").alias("inventory_item_id"),
        _id("product_id").alias("product_id"),
        _ts("created_at").alias("created_at"),
        _ts("sold_at").alias("sold_at"),
        _float("cost").alias("cost"),
        _text("product_category").alias("product_category"),
        _text("product_name").alias("product_name"),
        _text("product_brand").alias("product_brand"),
        _float("product_retail_price").alias("product_retail_price"),
        _text("product_department").alias("product_department"),
        _text("product_sku").alias("product_sku"),
        _id("product_distribution_center_id").alias("distribution_center_id"),
        *_lineage(batch_id))


def stg_order_items(raw: DataFrame, batch_id: str) -> DataFrame:
    return select_batch(raw, batch_id).select(
        _id("id").alias("order_item_id"),
        _id("order_id").alias("order_id"),
        _id("user_id").alias("customer_id"),
        _id("product_id").alias("product_id"),
        _id("inventory_item_id").alias("inventory_item_id"),
        F.lower(_text("status")).alias("order_item_status"),
        _ts("created_at").alias("created_at"),
        _ts("shipped_at").alias("shipped_at"),
        _ts("delivered_at").alias("delivered_at"),
        _ts("returned_at").alias("returned_at"),
        _float("sale_price").alias("sale_price"),
        *_lineage(batch_id))


def stg_orders(raw: DataFrame, batch_id: str) -> DataFrame:
    return select_batch(raw, batch_id).select(
        _id("order_id").alias("order_id"),
        _id("user_id").alias("customer_id"),
        F.lower(_text("status")).alias("order_status"),
        _text("gender").alias("gender"),
        _ts("created_at").alias("created_at"),
        _ts("returned_at").alias("returned_at"),
        _ts("shipped_at").alias("shipped_at"),
        _ts("delivered_at").alias("delivered_at"),
        _id("num_of_item").alias("order_item_count"),
        *_lineage(batch_id))


def stg_products(raw: DataFrame, batch_id: str) -> DataFrame:
    return select_batch(raw, batch_id).select(
        _id("id").alias("product_id"),
        _float("cost").alias("cost"),
        _text("category").alias("category"),
        _text("name").alias("product_name"),
        _text("brand").alias("brand"),
        _float("retail_price").alias("retail_price"),
        _text("department").alias("department"),
        _text("sku").alias("sku"),
        _id("distribution_center_id").alias("distribution_center_id"),
        *_lineage(batch_id, with_flag=False))


def stg_users(raw: DataFrame, batch_id: str) -> DataFrame:
    return select_batch(raw, batch_id).select(
        _id("id").alias("customer_id"),
        _text("first_name").alias("first_name"),
        _text("last_name").alias("last_name"),
        _text("email").alias("email"),
        _id("age").alias("age"),
        _text("gender").alias("gender"),
        _text("state").alias("state"),
        _text("street_address").alias("street_address"),
        _text("postal_code").alias("postal_code"),
        _text("city").alias("city"),
        _text("country").alias("country"),
        _float("latitude").alias("latitude"),
        _float("longitude").alias("longitude"),
        _text("traffic_source").alias("traffic_source"),
        _ts("created_at").alias("created_at"),
        _text("user_geom").alias("user_geom"),
        *_lineage(batch_id))


STAGING = {
    "distribution_centers": ("stg_distribution_centers", stg_distribution_centers),
    "events": ("stg_events", stg_events),
    "inventory_items": ("stg_inventory_items", stg_inventory_items),
    "order_items": ("stg_order_items", stg_order_items),
    "orders": ("stg_orders", stg_orders),
    "products": ("stg_products", stg_products),
    "users": ("stg_users", stg_users),
}


def stage_all(raw: dict[str, DataFrame], batch_id: str) -> dict[str, DataFrame]:
    """All seven staging DataFrames for one batch, keyed by model name."""
    return {model: fn(raw[table], batch_id) for table, (model, fn) in STAGING.items()}

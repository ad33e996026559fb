"""Fixed values the results depend on.

Everything in this module is a fixed value that must stay as written:
table names, batch-id format, status domains and the declared data tests.
"""

from __future__ import annotations

# --- fixed values: source tables and lineage -------------------------------
TABLES = (
    "distribution_centers",
    "events",
    "inventory_items",
    "order_items",
    "orders",
    "products",
    "users",
)
BATCH_COL = "_BATCH_ID"
EXTRACTED_COL = "_EXTRACTED_AT"
BATCH_ID_REGEX = r"[0-9]{8}T[0-9]{6}Z"          # must match the whole id
BATCH_ID_FORMAT = "yyyyMMdd'T'HHmmss'Z'"        # UTC extract second

# Source key per RAW table (orders uses ORDER_ID, all others ID).
RAW_KEYS = {
    "distribution_centers": "ID",
    "events": "ID",
    "inventory_items": "ID",
    "order_items": "ID",
    "orders": "ORDER_ID",
    "products": "ID",
    "users": "ID",
}

# RAW referential edges: (child, foreign key, parent, parent key).
RAW_RELATIONSHIPS = (
    ("orders", "USER_ID", "users", "ID"),
    ("order_items", "ORDER_ID", "orders", "ORDER_ID"),
    ("order_items", "USER_ID", "users", "ID"),
    ("order_items", "PRODUCT_ID", "products", "ID"),
    ("order_items", "INVENTORY_ITEM_ID", "inventory_items", "ID"),
    ("inventory_items", "PRODUCT_ID", "products", "ID"),
    ("inventory_items", "PRODUCT_DISTRIBUTION_CENTER_ID", "distribution_centers", "ID"),
    ("products", "DISTRIBUTION_CENTER_ID", "distribution_centers", "ID"),
    ("events", "USER_ID", "users", "ID"),
)
CATEGORY_COLUMNS = ("STATUS", "EVENT_TYPE")

# --- fixed values: statuses -------------------------------------------------
ITEM_STATUSES = ("shipped", "complete", "processing", "cancelled", "returned")
# Mart column prefix per staged status, in the mart's column order.
STATUS_COLUMN_NAMES = {
    "complete": "completed",
    "cancelled": "cancelled",
    "returned": "returned",
    "shipped": "shipped",
    "processing": "processing",
}
EVENT_TYPES = ("product", "cart", "department", "purchase", "cancel", "home")

# --- fixed values: declared data tests --------------------------------------
# Per model: not_null columns, unique columns, relationships
# {column: (parent model, parent column)}, accepted values {column: values},
# and the RAW table whose selected-batch count must equal the model's.
DECLARED_TESTS = {
    "stg_distribution_centers": {
        "not_null": ["distribution_center_id", "source_batch_id", "extracted_at"],
        "unique": ["distribution_center_id"],
        "row_count_source": "distribution_centers",
    },
    "stg_events": {
        "not_null": ["event_id", "event_type", "source_batch_id", "extracted_at"],
        "unique": ["event_id"],
        "relationships": {"customer_id": ("stg_users", "customer_id")},
        "accepted_values": {"event_type": EVENT_TYPES},
        "row_count_source": "events",
    },
    "stg_inventory_items": {
        "not_null": ["inventory_item_id", "product_id", "distribution_center_id",
                     "source_batch_id", "extracted_at"],
        "unique": ["inventory_item_id"],
        "relationships": {
            "product_id": ("stg_products", "product_id"),
            "distribution_center_id": ("stg_distribution_centers", "distribution_center_id"),
        },
        "row_count_source": "inventory_items",
    },
    "stg_order_items": {
        "not_null": ["order_item_id", "order_id", "customer_id", "product_id",
                     "inventory_item_id", "order_item_status", "source_batch_id", "extracted_at"],
        "unique": ["order_item_id"],
        "relationships": {
            "order_id": ("stg_orders", "order_id"),
            "customer_id": ("stg_users", "customer_id"),
            "product_id": ("stg_products", "product_id"),
            "inventory_item_id": ("stg_inventory_items", "inventory_item_id"),
        },
        "accepted_values": {"order_item_status": ITEM_STATUSES},
        "row_count_source": "order_items",
    },
    "stg_orders": {
        "not_null": ["order_id", "customer_id", "order_status", "source_batch_id", "extracted_at"],
        "unique": ["order_id"],
        "relationships": {"customer_id": ("stg_users", "customer_id")},
        "accepted_values": {"order_status": ITEM_STATUSES},
        "row_count_source": "orders",
    },
    "stg_products": {
        "not_null": ["product_id", "distribution_center_id", "source_batch_id", "extracted_at"],
        "unique": ["product_id"],
        "relationships": {
            "distribution_center_id": ("stg_distribution_centers", "distribution_center_id"),
        },
        "row_count_source": "products",
    },
    "stg_users": {
        "not_null": ["customer_id", "source_batch_id", "extracted_at"],
        "unique": ["customer_id"],
        "row_count_source": "users",
    },
    "dim_customers": {
        "not_null": ["customer_id", "source_batch_id"],
        "unique": ["customer_id"],
    },
    "dim_products": {
        "not_null": ["product_id", "source_batch_id"],
        "unique": ["product_id"],
    },
    "fct_order_items": {
        "not_null": ["order_item_id", "order_id", "customer_id", "product_id", "inventory_item_id",
                     "order_date", "order_item_status", "item_quantity", "item_amount",
                     "unit_cost", "source_batch_id"],
        "unique": ["order_item_id"],
        "relationships": {
            "order_id": ("stg_orders", "order_id"),
            "customer_id": ("dim_customers", "customer_id"),
            "product_id": ("dim_products", "product_id"),
            "inventory_item_id": ("stg_inventory_items", "inventory_item_id"),
        },
        "accepted_values": {
            "order_item_status": ("complete", "cancelled", "returned", "shipped", "processing"),
            "item_quantity": (1,),
        },
    },
    "mart_daily_sales": {
        "not_null": ["order_date", "source_batch_id", "order_count", "customer_count", "item_count"],
        "unique": ["order_date"],
    },
}

"""Singular reconciliations between models and an independent recomputation.

Each returns the violating keys; zero rows means the model reconciles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.functions.money import MONEY, iff_money
from martlet.functions.predicates import any_distinct


def _coverage(entity: str, source: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Row counts differ, or some source key (set semantics) is missing from the dimension.

    Both sides are tagged and grouped by key once (partial aggregation, one
    shuffle); the totals and the missing-key count come from that grouping.
    """
    tagged = (source.select(F.col(key).alias("k"), F.lit(1).alias("in_src"), F.lit(0).alias("in_dim"))
              .unionByName(dim.select(F.col(key).alias("k"), F.lit(0).alias("in_src"), F.lit(1).alias("in_dim"))))
    per_key = tagged.groupBy("k").agg(F.sum("in_src").alias("n_src"), F.sum("in_dim").alias("n_dim"))
    totals = per_key.agg(F.coalesce(F.sum("n_src"), F.lit(0)).alias("src_rows"),
                         F.coalesce(F.sum("n_dim"), F.lit(0)).alias("dim_rows"),
                         F.count_if((F.col("n_src") > 0) & (F.col("n_dim") == 0)).alias("missing_keys"))
    return (totals.filter((F.col("src_rows") != F.col("dim_rows")) | (F.col("missing_keys") > 0))
            .select(F.lit(entity).alias("entity")))


def dimension_coverage(stg_users: DataFrame, dim_customers: DataFrame,
                       stg_products: DataFrame, dim_products: DataFrame) -> DataFrame:
    """One literal row per entity whose dimension does not cover its staged source."""
    return (_coverage("customers", stg_users, dim_customers, "customer_id")
            .unionByName(_coverage("products", stg_products, dim_products, "product_id")))


def fact_reconciliation(fct: DataFrame, stg_items: DataFrame, stg_orders: DataFrame, stg_inventory: DataFrame,
                        stored: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Per-key reconciliation of the fact against its staged sources.

    Full outer fact<->items on the item id, then left joins to orders and
    inventory by id only (staging holds one batch). Twenty violation terms:
    every comparison is null-safe except the margin identity, which uses a
    plain ``<>`` (a NULL margin passes).

    The full outer join is written as its two halves so that every join is one
    AQE can split when a key is hot: fact LEFT JOIN items (a fanned-out item
    key on the fact side is split across tasks), plus the items whose key never
    occurs in the fact, found with an anti join against the fact's *distinct*
    keys. NULL keys behave as in the full outer join (they never match).

    Every term is judged as soon as its sides have met, and its columns go no further. ``stored`` may put
    either half into a table, so that its shuffles are gone before the next are made.
    """
    c = F.col
    f = fct.select(*[c(name).alias(f"f_{name}") for name in fct.columns])
    s = stg_items.select(*[c(name).alias(f"s_{name}") for name in stg_items.columns])
    o = stg_orders.select(c("order_id").alias("o_order_id"), c("created_at").cast("date").alias("o_order_date"),
                          c("source_batch_id").alias("o_source_batch_id"), c("customer_id").alias("o_customer_id"))
    i = stg_inventory.select(c("inventory_item_id").alias("i_inventory_item_id"), c("cost").alias("i_cost"),
                             c("source_batch_id").alias("i_source_batch_id"), c("product_id").alias("i_product_id"))
    s_amount = c("s_sale_price").cast(MONEY)
    status = c("s_order_item_status")
    at_item = any_distinct(
        [(c("f_order_id"), c("s_order_id")),
         (c("f_customer_id"), c("s_customer_id")),
         (c("f_product_id"), c("s_product_id")),
         (c("f_inventory_item_id"), c("s_inventory_item_id")),
         (c("f_order_item_status"), c("s_order_item_status")),
         (c("f_item_amount"), s_amount),
         (c("f_source_batch_id"), c("s_source_batch_id")),
         (c("f_completed_sales_amount"), iff_money(status == "complete", s_amount)),
         (c("f_cancelled_item_amount"), iff_money(status == "cancelled", s_amount)),
         (c("f_returned_item_amount"), iff_money(status == "returned", s_amount))],
        extra=[c("s_order_item_id").isNull(),
               F.coalesce(c("f_completed_gross_margin_amount") != c("f_completed_sales_amount") - c("f_completed_cost_amount"), F.lit(False))])
    # what the later terms read goes on, with the outcome of these
    ids = [F.coalesce("f_order_item_id", "s_order_item_id").alias("order_item_id"), "s_order_id", "s_inventory_item_id"]
    matched = (f.join(s, c("f_order_item_id") == c("s_order_item_id"), "left")
               .select(*ids, (c("f_order_item_id").isNull() | at_item).alias("violated"), "f_order_date", "f_source_batch_id", "f_customer_id", "f_product_id",
                       "f_unit_cost", "f_completed_cost_amount", (status == "complete").alias("s_is_complete")))
    fact_keys = fct.select(c("order_item_id").alias("k")).distinct()
    # an item without a fact row is a violation whatever else it holds, so only the join keys go along
    items_only = (s.select("s_order_item_id", "s_order_id", "s_inventory_item_id").join(fact_keys, c("s_order_item_id") == c("k"), "left_anti")
                  .select(c("s_order_item_id").alias("order_item_id"), "s_order_id", "s_inventory_item_id", F.lit(True).alias("violated")))
    outer = stored(matched).unionByName(stored(items_only), allowMissingColumns=True)
    at_order = any_distinct([(c("f_order_date"), c("o_order_date")), (c("f_source_batch_id"), c("o_source_batch_id")), (c("f_customer_id"), c("o_customer_id"))])
    ordered = (outer.join(o, c("s_order_id") == c("o_order_id"), "left").withColumn("violated", c("violated") | at_order)
               .drop("f_order_date", "f_customer_id", "s_order_id", *o.columns))
    i_cost = c("i_cost").cast(MONEY)
    at_unit = any_distinct([(c("f_unit_cost"), i_cost), (c("f_source_batch_id"), c("i_source_batch_id")), (c("f_product_id"), c("i_product_id")),
                            (c("f_completed_cost_amount"), iff_money(c("s_is_complete"), i_cost))])
    return (ordered.join(i, c("s_inventory_item_id") == c("i_inventory_item_id"), "left")
            .filter(c("violated") | at_unit).select("order_item_id"))


def order_quantities(stg_orders: DataFrame, fct: DataFrame) -> DataFrame:
    """Orders whose declared item count is distinct from the fact's item count.

    The fact is reduced to one count per order first (map-side partial
    aggregation); a NULL declared count is a violation (null-safe compare).
    """
    counts = fct.groupBy("order_id").agg(F.count(F.lit(1)).alias("item_count"))
    j = stg_orders.select("order_id", "order_item_count").join(counts, "order_id", "left")
    bad = ~F.col("order_item_count").eqNullSafe(F.coalesce(F.col("item_count"), F.lit(0)))
    return j.filter(bad).select("order_id")


DAILY_MEASURES = (
    "order_count", "customer_count", "item_count", "ordered_item_amount", "completed_sales_amount",
    "completed_cost_amount", "completed_gross_margin_amount", "cancelled_item_amount",
    "returned_item_amount", "future_created_item_count", "completed_item_count", "cancelled_item_count",
    "returned_item_count", "shipped_item_count", "processing_item_count",
)


def daily_expected(stg_items: DataFrame, stg_orders: DataFrame, stg_inventory: DataFrame) -> DataFrame:
    """Independent daily aggregate from staging (inner joins, ``count(*)`` items)."""
    o = stg_orders.select("order_id", "source_batch_id", F.col("created_at").alias("order_created_at"))
    inv = stg_inventory.select("inventory_item_id", "source_batch_id", F.col("cost").alias("inv_cost"))
    j = (stg_items.join(o, ["order_id", "source_batch_id"], "inner")
         .join(inv, ["inventory_item_id", "source_batch_id"], "inner"))
    price = F.col("sale_price").cast(MONEY)
    cost = F.col("inv_cost").cast(MONEY)
    status = F.col("order_item_status")

    def when_status(s, v):
        return F.sum(F.when(status == s, v).otherwise(F.lit(0)))

    return j.groupBy(F.col("order_created_at").cast("date").alias("order_date"), "source_batch_id").agg(
        F.count_distinct("order_id").alias("order_count"),
        F.count_distinct("customer_id").alias("customer_count"),
        F.count(F.lit(1)).alias("item_count"),
        F.sum(price).alias("ordered_item_amount"),
        when_status("complete", price).alias("completed_sales_amount"),
        when_status("complete", cost).alias("completed_cost_amount"),
        when_status("complete", price - cost).alias("completed_gross_margin_amount"),
        when_status("cancelled", price).alias("cancelled_item_amount"),
        when_status("returned", price).alias("returned_item_amount"),
        F.sum(F.when(F.col("is_created_after_extract"), 1).otherwise(0)).alias("future_created_item_count"),
        when_status("complete", 1).alias("completed_item_count"),
        when_status("cancelled", 1).alias("cancelled_item_count"),
        when_status("returned", 1).alias("returned_item_count"),
        when_status("shipped", 1).alias("shipped_item_count"),
        when_status("processing", 1).alias("processing_item_count"))


def daily_reconciliation(expected: DataFrame, mart: DataFrame) -> DataFrame:
    """Order dates where the mart and the independent aggregate disagree.

    Full outer join on (date, batch): a day on one side only is a violation,
    and a NULL date never matches, so it is always reported.
    """
    e = expected.select(*[F.col(c).alias(f"e_{c}") for c in ["order_date", "source_batch_id", *DAILY_MEASURES]])
    a = mart.select(*[F.col(c).alias(f"a_{c}") for c in ["order_date", "source_batch_id", *DAILY_MEASURES]])
    j = e.join(a, (F.col("e_order_date") == F.col("a_order_date"))
               & (F.col("e_source_batch_id") == F.col("a_source_batch_id")), "full")
    violated = any_distinct([(F.col(f"a_{m}"), F.col(f"e_{m}")) for m in DAILY_MEASURES],
                            extra=[F.col("e_order_date").isNull(), F.col("a_order_date").isNull()])
    return j.filter(violated).select(F.coalesce("e_order_date", "a_order_date").alias("order_date"))

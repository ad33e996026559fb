"""Deterministic tampering of built models, so reconciliations have work to find.

These stand in for a buggy build: the reconciliations compare the tampered
model with an independent recomputation from staging.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.functions.money import MONEY


#: One fault per compared fact column: items whose id leaves 1 modulo this prime get another value.
FACT_FAULTS = {
    "order_id": 211, "customer_id": 223, "product_id": 227, "inventory_item_id": 229, "order_item_status": 233,
    "item_amount": 239, "unit_cost": 103, "order_date": 241, "source_batch_id": 251, "completed_sales_amount": 257,
    "completed_cost_amount": 263, "completed_gross_margin_amount": 269, "cancelled_item_amount": 271,
    "returned_item_amount": 277,
}
#: One fault per measure of the mart: it drifts by one on this day of every March.
MART_FAULTS = {
    "order_count": 1, "customer_count": 2, "item_count": 3, "completed_item_count": 4, "cancelled_item_count": 5,
    "returned_item_count": 6, "shipped_item_count": 7, "processing_item_count": 8, "ordered_item_amount": 9,
    "completed_sales_amount": 10, "completed_cost_amount": 11, "completed_gross_margin_amount": 12,
    "cancelled_item_amount": 13, "returned_item_amount": 14, "future_created_item_count": 15,
}


def tamper_fact(fct: DataFrame) -> DataFrame:
    """Omit items with ``id % 101 = 7``, change one column each per ``FACT_FAULTS``, and duplicate
    items with ``id % 107 = 11`` (fan-out)."""
    kept = fct.filter(F.col("order_item_id") % 101 != 7)
    columns = []
    for f in kept.schema.fields:
        c = F.col(f.name)
        if f.name in FACT_FAULTS:
            kind = f.dataType.simpleString()
            other = {"bigint": c + 1, "string": F.concat(c, F.lit("-x")), "date": F.date_add(c, 1)}.get(
                kind, (c + F.lit(Decimal("0.0001"))).cast(MONEY))
            c = F.when(F.col("order_item_id") % FACT_FAULTS[f.name] == 1, other).otherwise(c).alias(f.name)
        columns.append(c)
    bumped = kept.select(*columns)
    return bumped.unionByName(bumped.filter(F.col("order_item_id") % 107 == 11))


def tamper_mart(mart: DataFrame) -> DataFrame:
    """Drift one measure each on the days of March in ``MART_FAULTS``, drop the 7th of February,
    and add a copy of each 4th of April moved forward by 36,500 days."""
    d = F.col("order_date")
    columns = []
    for f in mart.schema.fields:
        c = F.col(f.name)
        if f.name in MART_FAULTS:
            on_day = (F.month(d) == 3) & (F.dayofmonth(d) == MART_FAULTS[f.name])
            c = F.when(on_day, (c + 1).cast(f.dataType)).otherwise(c).alias(f.name)
        columns.append(c)
    drifted = mart.select(*columns)
    kept = drifted.filter(~((F.month(d) == 2) & (F.dayofmonth(d) == 7)))
    added = mart.filter((F.month(d) == 4) & (F.dayofmonth(d) == 4)).withColumn("order_date", F.date_add(d, 36500))
    return kept.unionByName(added)


def tamper_dim_customers(dim: DataFrame) -> DataFrame:
    """Drop customers with ``customer_id % 500 = 3``."""
    return dim.filter(F.col("customer_id") % 500 != 3)


def truncate_staged(df: DataFrame, key: str) -> DataFrame:
    """Drop every tenth key: a staged view that lost rows."""
    return df.filter(F.col(key) % 10 != 0)

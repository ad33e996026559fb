"""Seven RAW-shaped source tables derived from the driver's TPC-H-like tables.

Mapping (same values in Spark and in the DuckDB oracle):

* order_items / inventory_items <- lineitem, one row each; id = the line's
  rank in the global order (order key, line number, part, supplier, price),
  computed without any per-group window (``item_lines``).
* orders <- orders (+ real item count), users <- customer + nation,
  products <- part, distribution_centers <- supplier, events <- events.
* Batches: the first batch holds every row; the second holds the rows whose
  key is not divisible by 3 and has no events table (so it is incomplete).
  Keys therefore repeat across batches, as in an append-only RAW layer.

``faulty=True`` plants deterministic faults so that checks, reconciliations
and the profile have something to find (see ``plant_faults``).
"""

from __future__ import annotations

import threading
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martlet.config import TABLES
from martlet.session import work_dir
from martlet.sources.landing import lineage

# --- fixed values: fixture batches -----------------------------------------
SELECTED_BATCH = "20260101T000000Z"
SECOND_BATCH = "20260201T000000Z"
EXTRACTED_AT = {
    SELECTED_BATCH: {"sales": "2001-06-01 00:00:00", "events": "2024-01-29 00:00:00"},
    SECOND_BATCH: {"sales": "2001-07-01 00:00:00", "events": "2024-01-30 00:00:00"},
}
SOURCE_KEYS = {name: "id" for name in TABLES} | {"orders": "order_id"}
# Driver table each extract has one row per row of.
SOURCE_TABLE = {"distribution_centers": "supplier", "events": "events", "inventory_items": "lineitem",
                "order_items": "lineitem", "orders": "orders", "products": "part", "users": "customer"}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _days(n: int | Column) -> Column:
    return F.make_dt_interval((n if isinstance(n, Column) else F.lit(n)).cast("int"))


def _hours(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), n.cast("int"))


def _male_female(key: Column) -> Column:
    return F.when(key % 2 == 0, F.lit("F")).otherwise(F.lit("M"))


def _str(c: Column) -> Column:
    return c.cast("string")


ITEM_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
ITEM_COLUMNS = (*ITEM_ORDER, "l_discount", "l_returnflag", "l_linestatus", "l_shipdate")
_POS_BITS = 33  # monotonically_increasing_id() = partition index << 33 | position in partition
_LINES: dict[tuple, DataFrame] = {}
_LINES_LOCK = threading.Lock()


def item_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with a numeric order-item id: the row's rank in the global
    order of ``ITEM_ORDER`` (unique per line; an order's items are contiguous).

    No per-group window is used, so no order, however large, lands in one
    task: a range-partitioned sort spreads even one huge order over many
    tasks (the range bounds include the secondary sort columns). Only the columns
    that the extracts read take part. Each row's (partition, position) is taken once and
    written to the shared folder, so the partition sizes and the rows read the
    same stored data, each reader only its columns. The id is the position plus
    the rows of all earlier partitions; that offset table has one row per
    partition, so broadcasting it is bounded by the partition count. The rank
    does not depend on how rows were partitioned, so every evaluation yields
    the same ids. Computed once per application and source folder.
    """
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _LINES_LOCK:
        if key not in _LINES:
            _LINES[key] = _rank_lines(spark, sf_dir)
        return _LINES[key]


def _rank_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Global rank of every line in ``ITEM_ORDER`` (see ``item_lines``)."""
    path = work_dir(spark, "lines")
    located = (_read(spark, sf_dir, "lineitem").select(*ITEM_COLUMNS).repartitionByRange(*ITEM_ORDER)
               .sortWithinPartitions(*ITEM_ORDER)
               .withColumn("_mid", F.monotonically_increasing_id()))
    located.write.option("compression", "zstd").parquet(path)
    located = spark.read.schema(located.schema).parquet(path)
    part = F.shiftright("_mid", _POS_BITS)
    sizes = located.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # A running sum over ``sizes``: one row per partition, so this single-partition
    # window (and the broadcast below) is bounded by the partition count.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (located.withColumn("_part", part).join(F.broadcast(offsets), "_part")
            .withColumn("item_id", F.col("_offset") + F.col("_mid").bitwiseAND((1 << _POS_BITS) - 1) + 1)
            .drop("_mid", "_part", "_offset"))


def _item_status() -> Column:
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    return (F.when((rf == "N") & (ls == "F"), "Complete")
             .when((rf == "N") & (ls == "O"), "Shipped")
             .when(rf == "R", "Returned")
             .when((rf == "A") & (ls == "F"), "Cancelled")
             .when((rf == "A") & (ls == "O"), "Processing"))


def order_items_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    # only what the extract needs goes through the join
    lines = item_lines(spark, sf_dir).select("l_orderkey", "item_id", "l_partkey", _item_status().alias("status"), "l_shipdate", "l_extendedprice")
    buyers = _read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    status = F.col("status")
    created = F.col("l_shipdate").cast("timestamp")
    return (lines.join(buyers, "l_orderkey", "left")
            .select(F.col("item_id").alias("id"),
                    F.col("l_orderkey").alias("order_id"),
                    F.col("o_custkey").alias("user_id"),
                    F.col("l_partkey").alias("product_id"),
                    F.col("item_id").alias("inventory_item_id"),
                    status,
                    created.alias("created_at"),
                    F.when(status.isin("Shipped", "Complete", "Returned"), created + _days(1)).alias("shipped_at"),
                    F.when(status.isin("Complete", "Returned"), created + _days(3)).alias("delivered_at"),
                    F.when(status == "Returned", created + _days(10)).alias("returned_at"),
                    F.col("l_extendedprice").alias("sale_price")))


def orders_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = (_read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
              .agg(F.count(F.lit(1)).alias("n_items")))
    o = _read(spark, sf_dir, "orders").join(counts, "o_orderkey", "left")
    status = (F.when(F.col("o_orderstatus") == "F", "Complete")
               .when(F.col("o_orderstatus") == "O", "Shipped")
               .when(F.col("o_orderstatus") == "P", "Processing"))
    created = F.col("o_orderdate").cast("timestamp") + _hours(F.col("o_orderkey") % 24)
    return o.select(F.col("o_orderkey").alias("order_id"),
                    F.col("o_custkey").alias("user_id"),
                    status.alias("status"),
                    _male_female(F.col("o_custkey")).alias("gender"),
                    created.alias("created_at"),
                    F.lit(None).cast("timestamp").alias("returned_at"),
                    F.when(status.isin("Complete", "Shipped"), created + _days(2)).alias("shipped_at"),
                    F.when(status == "Complete", created + _days(5)).alias("delivered_at"),
                    F.coalesce(F.col("n_items"), F.lit(0)).cast("bigint").alias("num_of_item"))


def _brand(partkey: Column, brand: Column) -> Column:
    return F.when(partkey % 97 == 0, F.lit(None).cast("string")).otherwise(brand)


def _department(size: Column) -> Column:
    return F.when(size % 2 == 0, F.lit("Women")).otherwise(F.lit("Men"))


def inventory_items_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    cost = F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))
    lines = item_lines(spark, sf_dir).select("l_partkey", "item_id", "l_suppkey", "l_shipdate", cost.alias("cost"))
    part = _read(spark, sf_dir, "part").withColumnRenamed("p_partkey", "l_partkey")
    shipped = F.col("l_shipdate").cast("timestamp")
    return (lines.join(part, "l_partkey", "left")
            .select(F.col("item_id").alias("id"),
                    F.col("l_partkey").alias("product_id"),
                    (shipped - _days(30)).alias("created_at"),
                    shipped.alias("sold_at"),
                    "cost",
                    F.col("p_type").alias("product_category"),
                    F.col("p_name").alias("product_name"),
                    _brand(F.col("l_partkey"), F.col("p_brand")).alias("product_brand"),
                    F.col("p_retailprice").alias("product_retail_price"),
                    _department(F.col("p_size")).alias("product_department"),
                    F.concat(F.lit("SKU-"), _str(F.col("l_partkey"))).alias("product_sku"),
                    F.col("l_suppkey").alias("product_distribution_center_id")))


def products_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    n_centers = _read(spark, sf_dir, "supplier").agg(F.count(F.lit(1))).scalar()
    p = _read(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("id"),
                    (F.col("p_retailprice") * F.lit(0.5)).alias("cost"),
                    F.col("p_type").alias("category"),
                    F.col("p_name").alias("name"),
                    _brand(F.col("p_partkey"), F.col("p_brand")).alias("brand"),
                    F.col("p_retailprice").alias("retail_price"),
                    _department(F.col("p_size")).alias("department"),
                    F.concat(F.lit("SKU-"), _str(F.col("p_partkey"))).alias("sku"),
                    (F.col("p_partkey") % n_centers).alias("distribution_center_id"))


def users_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    n = _read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    key, nat = F.col("c_custkey"), F.col("c_nationkey")
    return (c.join(n, "c_nationkey", "left")
            .select(key.alias("id"),
                    F.col("c_name").alias("first_name"),
                    F.concat(F.lit("Family-"), _str(key % 100)).alias("last_name"),
                    F.concat(F.lit("customer"), _str(key), F.lit("@example.com")).alias("email"),
                    (F.lit(18) + key % 60).cast("bigint").alias("age"),
                    _male_female(key).alias("gender"),
                    F.concat(F.lit("State-"), _str(nat % 5)).alias("state"),
                    F.concat(_str(key), F.lit(" Main Street")).alias("street_address"),
                    F.lpad(_str(key % 100000), 5, "0").alias("postal_code"),
                    F.concat(F.lit("City-"), _str(nat)).alias("city"),
                    F.col("n_name").alias("country"),
                    nat.cast("double").alias("latitude"),
                    F.col("c_acctbal").alias("longitude"),
                    F.col("c_mktsegment").alias("traffic_source"),
                    (F.lit("1994-01-01 00:00:00").cast("timestamp") + _days(key * 37 % 3000)).alias("created_at"),
                    F.concat(F.lit("POINT("), _str(nat), F.lit(" "), _str(key), F.lit(")")).alias("user_geom")))


def events_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "events")
    key = F.col("event_id")
    browser = (F.when(key % 4 == 0, "Chrome").when(key % 4 == 1, "Firefox")
                .when(key % 4 == 2, "Safari").otherwise("Edge"))
    source = F.when(key % 3 == 0, "Search").when(key % 3 == 1, "Email").otherwise("Organic")
    return e.select(key.alias("id"),
                    F.when(key % 3 == 0, F.lit(None).cast("bigint")).otherwise(F.col("user_id")).alias("user_id"),
                    (key % 10 + 1).alias("sequence_number"),
                    F.concat(F.lit("session-"), _str(F.floor(key / 10))).alias("session_id"),
                    F.col("ts").cast("timestamp").alias("created_at"),
                    F.concat(F.lit("10.0."), _str(key % 256), F.lit(".1")).alias("ip_address"),
                    F.concat(F.lit("City-"), _str(key % 25)).alias("city"),
                    F.concat(F.lit("State-"), _str(key % 5)).alias("state"),
                    F.lpad(_str(key % 100000), 5, "0").alias("postal_code"),
                    browser.alias("browser"),
                    source.alias("traffic_source"),
                    F.concat(F.lit("/"), F.col("event_type")).alias("uri"),
                    F.col("event_type").alias("event_type"))


def distribution_centers_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _read(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").alias("id"),
                    F.col("s_name").alias("name"),
                    F.col("s_nationkey").cast("double").alias("latitude"),
                    F.col("s_acctbal").alias("longitude"),
                    F.concat(F.lit("POINT("), _str(F.col("s_nationkey")), F.lit(" "),
                             _str(F.col("s_suppkey")), F.lit(")")).alias("distribution_center_geom"))


EXTRACTORS = {
    "distribution_centers": distribution_centers_extract,
    "events": events_extract,
    "inventory_items": inventory_items_extract,
    "order_items": order_items_extract,
    "orders": orders_extract,
    "products": products_extract,
    "users": users_extract,
}


def plant_faults(name: str, df: DataFrame) -> DataFrame:
    """Deterministic faults, one family per check type.

    users: parents with ``id % 7 = 0`` missing (orphans) · distribution_centers:
    ``id % 9 = 4`` missing · orders: declared item count 4, NULL when
    ``order_id % 50 = 0``; orders with ``order_id % 1000 = 1`` delivered twice
    (duplicate key, fact fan-out) · order_items: status ``Lost`` when
    ``id % 97 = 3``, buyer shifted by one when ``order_id % 11 = 0``, NULL
    product when ``id % 211 = 0`` · events: NULL id when ``id % 997 = 0``.
    """
    if name == "users":
        return df.filter(F.col("id") % 7 != 0)
    if name == "distribution_centers":
        return df.filter(F.col("id") % 9 != 4)
    if name == "orders":
        df = df.withColumn("num_of_item", F.when(F.col("order_id") % 50 == 0, F.lit(None).cast("bigint"))
                           .otherwise(F.lit(4).cast("bigint")))
        return df.unionByName(df.filter(F.col("order_id") % 1000 == 1))
    if name == "order_items":
        return (df.withColumn("status", F.when(F.col("id") % 97 == 3, F.lit("Lost")).otherwise(F.col("status")))
                  .withColumn("user_id", F.when(F.col("order_id") % 11 == 0, F.col("user_id") + 1)
                              .otherwise(F.col("user_id")))
                  .withColumn("product_id", F.when(F.col("id") % 211 == 0, F.lit(None).cast("bigint"))
                              .otherwise(F.col("product_id"))))
    if name == "events":
        return df.withColumn("id", F.when(F.col("id") % 997 == 0, F.lit(None).cast("bigint"))
                             .otherwise(F.col("id")))
    return df


def extract(spark: SparkSession, sf_dir: str, name: str, faulty: bool = False) -> DataFrame:
    """The source extract of one table (lower-case source column names)."""
    df = EXTRACTORS[name](spark, sf_dir)
    return plant_faults(name, df) if faulty else df


def _extracted_at(batch_id: str, name: str) -> str:
    return EXTRACTED_AT[batch_id]["events" if name == "events" else "sales"]


def raw_table(spark: SparkSession, sf_dir: str, name: str, faulty: bool = False) -> DataFrame:
    """RAW table: every batch that landed for ``name``, stamped with lineage.

    The extract is computed once; a row is repeated for every batch that holds it.
    """
    src = extract(spark, sf_dir, name, faulty)
    stamps = [lineage(batch, _extracted_at(batch, name)) for batch in (SELECTED_BATCH, SECOND_BATCH)]
    held = F.array(stamps[0])
    if name != "events":
        held = F.when(F.col(SOURCE_KEYS[name]) % 3 != 0, F.array(*stamps)).otherwise(held)
    return src.toDF(*[c.upper() for c in src.columns]).select("*", F.inline(held))


def raw_tables(spark: SparkSession, sf_dir: str, faulty: bool = False) -> dict[str, DataFrame]:
    return {name: raw_table(spark, sf_dir, name, faulty) for name in TABLES}

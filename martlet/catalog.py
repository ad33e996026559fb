"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the driver tables under ``sf_dir`` through the RAW fixture
(``sources.driver_tables``), so its work grows with the tables. Queries
ending in checks/reconciliations/profiles run on the planted-fault variant
(``faulty=True``) or on a deliberately tampered model, so their results are
non-empty evidence rather than a bare "0 violations".
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from martlet.config import TABLES
from martlet.functions.batch_ids import batch_id_from_ts, is_valid_batch_id
from martlet.operators import asof, checks, cubes, export, funnel, history, profile, reconcile, sessions, sketches, spine, topk
from martlet.plans import incremental, marts
from martlet.plans.batch_build import Build, build, materialize
from martlet.plans.staging import select_batch, stg_events
from martlet.session import configure, remove_folder, size_shuffles, work_dir
from martlet.sources import faults, landing
from martlet.sources.driver_tables import (EXTRACTED_AT, SECOND_BATCH, SELECTED_BATCH, SOURCE_KEYS, SOURCE_TABLE,
                                           extract, raw_tables)
from martlet.sources.raw_store import LandedOnUse, read_raw_like
from martlet.streaming import event_windows, landing_stream

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = fn
        return fn
    return deco


def _sources(spark: SparkSession, sf_dir: str) -> tuple:
    """The driver tables' files (path, size, time): what a result kept for this folder was computed from."""
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    files = []
    for name in sorted(set(SOURCE_TABLE.values())):
        path = Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        for st in path.getFileSystem(conf).listStatus(path):
            files.append((st.getPath().toString(), st.getLen(), st.getModificationTime()))
    return tuple(sorted(files))


_STORED: dict[tuple, LandedOnUse] = {}
_LOCK = threading.RLock()  # callers may run queries from several threads


def stored_raw(spark: SparkSession, sf_dir: str, faulty: bool = False) -> LandedOnUse:
    """RAW derived from the driver tables, every table landed once per application, on its first use, as a
    ``_BATCH_ID``-partitioned Parquet table in the checkpoint folder."""
    configure(spark)
    key = (spark.sparkContext.applicationId, _sources(spark, sf_dir), faulty)
    size_shuffles(spark, sum(size for _, size, _ in key[1]))
    with _LOCK:
        if key not in _STORED:
            root = work_dir(spark, "raw-faulty" if faulty else "raw")
            _STORED[key] = LandedOnUse(spark, raw_tables(spark, sf_dir, faulty=faulty), root)
        return _STORED[key]


_BUILDS: dict[tuple, Build] = {}


def _cached_build(spark: SparkSession, sf_dir: str, faulty: bool) -> Build:
    """One lazily built set of models per application and input: DataFrames are
    immutable plans, so queries reuse the already analysed staging models."""
    key = (spark.sparkContext.applicationId, _sources(spark, sf_dir), faulty, "views")
    with _LOCK:
        if key not in _BUILDS:
            _BUILDS[key] = build(stored_raw(spark, sf_dir, faulty=faulty), SELECTED_BATCH)
        return _BUILDS[key]


def clean_build(spark: SparkSession, sf_dir: str) -> Build:
    return _cached_build(spark, sf_dir, False)


def faulty_build(spark: SparkSession, sf_dir: str) -> Build:
    return _cached_build(spark, sf_dir, True)


def _written_fact(spark: SparkSession, b: Build, root: str) -> DataFrame:
    """The fact as a table; its joins run one after the other, with a table between them that goes when the fact is written."""
    def stored(priced: DataFrame) -> DataFrame:
        # all staged rows are of one batch, whose id need not be stored or shuffled
        return materialize(priced.drop("source_batch_id"), f"{root}/priced_items").withColumn("source_batch_id", F.lit(b.batch_id))

    fct = marts.fct_order_items(*(b.staged[m] for m in ("stg_order_items", "stg_orders", "stg_inventory_items")), stored)
    fct = materialize(fct, f"{root}/fct_order_items")
    remove_folder(spark, f"{root}/priced_items")
    return fct


def built_tables(spark: SparkSession, sf_dir: str, faulty: bool = False) -> Build:
    """The build with fact and mart written as tables (as they are in production; the mart
    on its first use): checks and reconciliations read them from Parquet instead of re-joining
    and re-aggregating staging for every check."""
    b = faulty_build(spark, sf_dir) if faulty else clean_build(spark, sf_dir)
    key = (spark.sparkContext.applicationId, _sources(spark, sf_dir), faulty, "tables")
    with _LOCK:
        if key not in _BUILDS:
            root = work_dir(spark, "marts-faulty" if faulty else "marts")
            b.raw.land(("order_items", "orders", "inventory_items"))
            fct = _written_fact(spark, b, root)
            _BUILDS[key] = b.with_tables(fct, lambda: materialize(marts.mart_daily_sales(fct), f"{root}/mart_daily_sales"))
        return _BUILDS[key]


# --- models ----------------------------------------------------------------

@register("mart_daily_sales")
def q_mart_daily_sales(spark, sf_dir):
    return clean_build(spark, sf_dir).mart_daily_sales


@register("fct_order_items")
def q_fct_order_items(spark, sf_dir):
    return clean_build(spark, sf_dir).fct_order_items


@register("dim_customers")
def q_dim_customers(spark, sf_dir):
    return clean_build(spark, sf_dir).dim_customers


@register("dim_products")
def q_dim_products(spark, sf_dir):
    return clean_build(spark, sf_dir).dim_products


def _staging_query(model: str) -> QueryFn:
    def q(spark, sf_dir):
        return clean_build(spark, sf_dir).staged[model]
    q.__name__ = f"q_{model}"
    return q


for _model in ("stg_distribution_centers", "stg_events", "stg_inventory_items", "stg_order_items",
               "stg_orders", "stg_products", "stg_users"):
    register(_model)(_staging_query(_model))


@register("sales_kpis")
def q_sales_kpis(spark, sf_dir):
    return marts.sales_kpis(built_tables(spark, sf_dir).fct_order_items)


@register("latest_order_dates")
def q_latest_order_dates(spark, sf_dir):
    return marts.latest_order_dates(built_tables(spark, sf_dir).mart_daily_sales)


# --- checks (planted-fault fixture) -------------------------------------------


@register("check_not_null")
def q_check_not_null(spark, sf_dir):
    return checks.not_null_suite(built_tables(spark, sf_dir, faulty=True).models())


@register("check_unique")
def q_check_unique(spark, sf_dir):
    return checks.unique_suite(built_tables(spark, sf_dir, faulty=True).models())


@register("check_relationships")
def q_check_relationships(spark, sf_dir):
    return checks.relationships_suite(built_tables(spark, sf_dir, faulty=True).models())


@register("check_accepted_values")
def q_check_accepted_values(spark, sf_dir):
    return checks.accepted_values_suite(built_tables(spark, sf_dir, faulty=True).models())


@register("check_batch_row_count")
def q_check_batch_row_count(spark, sf_dir):
    """Staged events lose every tenth key; events are also checked for the
    second batch, which has no RAW events (``raw_rows = 0``)."""
    b = clean_build(spark, sf_dir)
    models = dict(b.staged.items())
    models["stg_events"] = faults.truncate_staged(models["stg_events"], "event_id")
    selected = checks.batch_row_count_suite(models, b.raw, SELECTED_BATCH)
    empty = checks.batch_row_count("stg_events", stg_events(b.raw["events"], SECOND_BATCH), "events",
                                   b.raw["events"], SECOND_BATCH)
    return selected.unionByName(empty)


@register("check_summary")
def q_check_summary(spark, sf_dir):
    b = built_tables(spark, sf_dir, faulty=True)
    return checks.check_summary(b.models(), b.raw, SELECTED_BATCH)


# --- reconciliations ------------------------------------------------------------

@register("recon_dimension_coverage")
def q_recon_dimension_coverage(spark, sf_dir):
    b = clean_build(spark, sf_dir)
    return reconcile.dimension_coverage(b.staged["stg_users"], faults.tamper_dim_customers(b.dim_customers),
                                        b.staged["stg_products"], b.dim_products)


@register("recon_fact")
def q_recon_fact(spark, sf_dir):
    b = built_tables(spark, sf_dir)
    return reconcile.fact_reconciliation(faults.tamper_fact(b.fct_order_items), b.staged["stg_order_items"], b.staged["stg_orders"],
                                         b.staged["stg_inventory_items"], lambda half: materialize(half, work_dir(spark, "recon-fact")))


@register("recon_order_quantities")
def q_recon_order_quantities(spark, sf_dir):
    b = built_tables(spark, sf_dir, faulty=True)
    return reconcile.order_quantities(b.staged["stg_orders"], b.fct_order_items)


@register("recon_daily_expected")
def q_recon_daily_expected(spark, sf_dir):
    s = clean_build(spark, sf_dir).staged
    return reconcile.daily_expected(s["stg_order_items"], s["stg_orders"], s["stg_inventory_items"])


@register("recon_daily")
def q_recon_daily(spark, sf_dir):
    b = built_tables(spark, sf_dir)
    s = b.staged
    expected = reconcile.daily_expected(s["stg_order_items"], s["stg_orders"], s["stg_inventory_items"])
    return reconcile.daily_reconciliation(expected, faults.tamper_mart(b.mart_daily_sales))


# --- batch profile (planted-fault RAW, selected batch) ---------------------------

def _faulty_raw(spark, sf_dir):
    return stored_raw(spark, sf_dir, faulty=True)


def _per_table(fn):
    def q(spark, sf_dir):
        raw = _faulty_raw(spark, sf_dir)
        parts = [fn(t, raw[t], SELECTED_BATCH) for t in TABLES]
        return checks.union_all([p for p in parts if p is not None])
    return q


register("profile_keys")(_per_table(profile.key_profile))
register("profile_null_counts")(_per_table(profile.null_counts))
register("profile_date_ranges")(_per_table(profile.date_ranges))
register("profile_future_timestamps")(_per_table(profile.future_timestamps))
_category_counts = _per_table(profile.category_counts)


@register("profile_category_counts")
def q_profile_category_counts(spark, sf_dir):
    """Category frequencies, most frequent first within each column (a small sorted result)."""
    return _category_counts(spark, sf_dir).orderBy("table_name", "column_name", F.desc("row_count"), "value")


@register("profile_orphans")
def q_profile_orphans(spark, sf_dir):
    return profile.orphans(_faulty_raw(spark, sf_dir), SELECTED_BATCH)


@register("profile_user_mismatch")
def q_profile_user_mismatch(spark, sf_dir):
    raw = _faulty_raw(spark, sf_dir)
    return profile.user_mismatches(raw["order_items"], raw["orders"], SELECTED_BATCH)


@register("profile_item_count_mismatch")
def q_profile_item_count_mismatch(spark, sf_dir):
    raw = _faulty_raw(spark, sf_dir)
    return profile.item_count_mismatches(raw["order_items"], raw["orders"], SELECTED_BATCH)


@register("profile_gate")
def q_profile_gate(spark, sf_dir):
    raw = _faulty_raw(spark, sf_dir)
    sources = {t: extract(spark, sf_dir, t, faulty=True) for t in TABLES}
    return profile.gate(profile.table_summary(raw, sources, SELECTED_BATCH))


# --- landing and batch selection ------------------------------------------------



def utc_wall_clock(df: DataFrame) -> DataFrame:
    """Render tz-aware timestamp columns as UTC ``TIMESTAMP_NTZ`` for stable output."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, TimestampType)
                       else F.col(f.name) for f in df.schema.fields])


def _stamped(spark, sf_dir, table, batch_id):
    src = extract(spark, sf_dir, table)
    if batch_id != SELECTED_BATCH:
        src = src.filter(F.col(SOURCE_KEYS[table]) % 3 != 0)
    family = "events" if table == "events" else "sales"
    return landing.stamp_batch(src, batch_id, EXTRACTED_AT[batch_id][family])


@register("select_batch")
def q_select_batch(spark, sf_dir):
    return utc_wall_clock(select_batch(stored_raw(spark, sf_dir)["orders"], SECOND_BATCH))


def _event_instants(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"))


@register("land_batch_id_from_ts")
def q_land_batch_id_from_ts(spark, sf_dir):
    configure(spark)
    return _event_instants(spark, sf_dir).select("event_id", batch_id_from_ts("ts").alias("batch_id"))


@register("valid_batch_ids")
def q_valid_batch_ids(spark, sf_dir):
    """Each event's batch id plus three malformed variants (date only, trailing
    newline, leading space), validated with the whole-string rule."""
    configure(spark)
    bid = batch_id_from_ts("ts")
    variants = _event_instants(spark, sf_dir).select(
        "event_id",
        F.inline(F.array(
            F.struct(F.lit("as_extracted").alias("variant"), bid.alias("candidate")),
            F.struct(F.lit("date_only").alias("variant"), F.substring(bid, 1, 8).alias("candidate")),
            F.struct(F.lit("trailing_newline").alias("variant"), F.concat(bid, F.lit("\n")).alias("candidate")),
            F.struct(F.lit("leading_space").alias("variant"), F.concat(F.lit(" "), bid).alias("candidate")))))
    return variants.select("event_id", "variant", "candidate", is_valid_batch_id("candidate").alias("is_valid"))


@register("land_stamp_batch")
def q_land_stamp_batch(spark, sf_dir):
    configure(spark)
    return utc_wall_clock(_stamped(spark, sf_dir, "orders", SELECTED_BATCH))


@register("land_rowcount_guard")
def q_land_rowcount_guard(spark, sf_dir):
    """Land all seven stamped extracts with the torn-write guard."""
    configure(spark)
    stamped = {t: _stamped(spark, sf_dir, t, SELECTED_BATCH) for t in TABLES}
    # The source's own row count: each extract is one row per row of its driver
    # table, counted from Parquet footers (no data pages read).
    expected = {t: spark.read.parquet(f"{sf_dir}/{SOURCE_TABLE[t]}.parquet").count() for t in TABLES}
    return landing.rowcount_guard(spark, stamped, f"{work_dir(spark, 'landed')}/{SELECTED_BATCH}", expected)


def _manifest(spark, sf_dir):
    return landing.batch_manifest(stored_raw(spark, sf_dir))


@register("land_complete_batches")
def q_land_complete_batches(spark, sf_dir):
    return landing.complete_batches(_manifest(spark, sf_dir))


@register("land_latest_batch")
def q_land_latest_batch(spark, sf_dir):
    return landing.latest_batch(_manifest(spark, sf_dir))


@register("land_idempotent_append")
def q_land_idempotent_append(spark, sf_dir):
    """Stream the first batch in twice (second pass loads nothing), re-deliver
    its orders under new paths (ledger drops them), then land the second batch.
    Returns the RAW row count per (table, batch)."""
    raw_root, _ = _landing_runs(spark, sf_dir)
    return landing_stream.raw_batch_counts(spark, raw_root, TABLES)


# --- export ----------------------------------------------------------------------

def _exported(spark, sf_dir):
    configure(spark)
    work = work_dir(spark, "export")
    mart = built_tables(spark, sf_dir).mart_daily_sales        # the written mart table
    return mart, export.export_and_record(spark, mart, f"{work}/portfolio")


@register("export_daily_mart")
def q_export_daily_mart(spark, sf_dir):
    _, paths = _exported(spark, sf_dir)
    return spark.read.parquet(paths["parquet"])


@register("export_verify")
def q_export_verify(spark, sf_dir):
    mart, paths = _exported(spark, sf_dir)
    return export.verify_export(spark, mart, paths)


@register("export_fingerprint")
def q_export_fingerprint(spark, sf_dir):
    mart, paths = _exported(spark, sf_dir)
    return export.fingerprint_export(spark, mart, paths)


@register("profile_batch")
def q_profile_batch(spark, sf_dir):
    """The full per-table profile (one aggregate per table), long form."""
    raw = _faulty_raw(spark, sf_dir)
    return checks.union_all([profile.table_profile(t, raw[t], extract(spark, sf_dir, t, faulty=True), SELECTED_BATCH)
                          for t in TABLES])


def _landing_runs(spark, sf_dir):
    """First batch streamed twice, its orders re-delivered, then the second batch."""
    configure(spark)
    work = work_dir(spark, "stream-landing")
    zone, raw_root, ckpt = f"{work}/landing", f"{work}/raw", f"{work}/checkpoints"
    first = {t: _stamped(spark, sf_dir, t, SELECTED_BATCH) for t in TABLES}
    schemas = {t: df.schema for t, df in first.items()}
    for t, df in first.items():
        landing_stream.land_files(df, zone, t, SELECTED_BATCH)
    runs = [landing_stream.run_landing(spark, zone, raw_root, schemas, ckpt),
            landing_stream.run_landing(spark, zone, raw_root, schemas, ckpt)]
    landing_stream.land_files(first["orders"], zone, "orders", f"{SELECTED_BATCH}-redelivered")
    for t in TABLES:
        if t != "events":
            landing_stream.land_files(_stamped(spark, sf_dir, t, SECOND_BATCH), zone, t, SECOND_BATCH)
    runs.append(landing_stream.run_landing(spark, zone, raw_root, schemas, ckpt))
    return raw_root, runs


@register("land_stream_metrics")
def q_land_stream_metrics(spark, sf_dir):
    """Rows read / written per table in each of the three streaming passes."""
    _, runs = _landing_runs(spark, sf_dir)
    rows = [(i + 1, t, read, written) for i, run in enumerate(runs) for t, (read, written) in sorted(run.items())]
    return spark.createDataFrame(rows, "run int, table_name string, rows_read bigint, rows_written bigint")


@register("land_batch_append")
def q_land_batch_append(spark, sf_dir):
    """Batch variant of the idempotent append: the first batch twice (second
    append writes 0 rows), then the second batch; RAW counts per (table, batch)."""
    configure(spark)
    raw_root = f"{work_dir(spark, 'batch-landing')}/raw"
    for batch in (SELECTED_BATCH, SELECTED_BATCH, SECOND_BATCH):
        for t in TABLES:
            if batch == SECOND_BATCH and t == "events":
                continue
            landing.append_new_batches(spark, _stamped(spark, sf_dir, t, batch), raw_root, t)
    return landing_stream.raw_batch_counts(spark, raw_root, TABLES)


@register("land_aligned_append")
def q_land_aligned_append(spark, sf_dir):
    """RAW contents after a second batch that arrives with lower-case names in reverse order, without ``GENDER`` and
    with a column RAW does not know, once through the batch append and once through the stream."""
    configure(spark)
    work = work_dir(spark, "aligned-landing")
    first, second = (_stamped(spark, sf_dir, "orders", b) for b in (SELECTED_BATCH, SECOND_BATCH))
    drifted = second.drop("GENDER").withColumn("unknown_to_raw", F.lit("x"))
    drifted = drifted.select(*[F.col(c).alias(c.lower()) for c in reversed(drifted.columns)])
    landing.append_new_batches(spark, first, f"{work}/batch", "orders")
    landing.append_new_batches(spark, drifted, f"{work}/batch", "orders")
    landing_stream.land_files(first, f"{work}/landing", "orders", SELECTED_BATCH)
    landing_stream.land_files(drifted, f"{work}/landing", "orders", SECOND_BATCH)
    landing_stream.run_landing(spark, f"{work}/landing", f"{work}/stream", {"orders": first.schema}, f"{work}/checkpoints")
    both = [utc_wall_clock(read_raw_like(spark, f"{work}/{path}/orders", first.schema)).select(F.lit(path).alias("load_path"), "*")
            for path in ("batch", "stream")]
    return both[0].unionByName(both[1])


# --- event sessions ------------------------------------------------------------------


def _sessions(spark, sf_dir):
    events = clean_build(spark, sf_dir).staged["stg_events"].select("event_id", "customer_id", "created_at", "event_type")
    return sessions.event_sessions(events)


@register("event_sessions")
def q_event_sessions(spark, sf_dir):
    """Every event with its session; anonymous events are one long sequence."""
    configure(spark)
    return _sessions(spark, sf_dir).drop("event_type")


@register("session_summary")
def q_session_summary(spark, sf_dir):
    configure(spark)
    return sessions.session_summary(_sessions(spark, sf_dir))


# --- day axis with running totals --------------------------------------------------------


@register("daily_running_totals")
def q_daily_running_totals(spark, sf_dir):
    """The daily mart on a gapless day axis, with running, month-to-date and week-over-week totals."""
    configure(spark)
    return spine.running_totals(built_tables(spark, sf_dir).mart_daily_sales, ["source_batch_id"], "order_date",
                                ["order_count", "item_count", "ordered_item_amount", "completed_gross_margin_amount"])


@register("status_running_totals")
def q_status_running_totals(spark, sf_dir):
    """Items and money of each item status by day, straight from the fact's rows; a few statuses hold all rows."""
    configure(spark)
    return spine.running_totals(built_tables(spark, sf_dir).fct_order_items, ["order_item_status"], "order_date",
                                ["item_quantity", "item_amount"], period_days=28)


# --- history over batches ---------------------------------------------------------------

HISTORY_BATCHES = ((SELECTED_BATCH, "2026-01-01 00:00:00"), (SECOND_BATCH, "2026-02-01 00:00:00"), ("20260301T000000Z", "2026-03-01 00:00:00"))


def _user_snapshots(spark, sf_dir):
    """Three extracts: all users; those not divisible by 3, some moved or a year older; all again, some back where they were, some without a city."""
    users = extract(spark, sf_dir, "users").select(F.col("id").alias("customer_id"), "state", "city", "age")
    key = F.col("customer_id")
    second = users.filter(key % 3 != 0).select("customer_id", F.when(key % 5 == 1, "Moved").otherwise(F.col("state")).alias("state"), "city",
                                               (F.col("age") + F.when(key % 4 == 2, 1).otherwise(0)).alias("age"))
    third = users.select("customer_id", F.when(key % 10 == 1, "Moved").otherwise(F.col("state")).alias("state"),
                         F.when(key % 8 != 5, F.col("city")).alias("city"), "age")
    return [users, second, third]


def _product_snapshots(spark, sf_dir):
    """Three extracts: all products; those not divisible by 3, some at twice the price; all again, some without a brand."""
    products = extract(spark, sf_dir, "products").select(F.col("id").alias("product_id"), "brand", "retail_price")
    key = F.col("product_id")
    price = lambda n, k: F.col("retail_price") * F.when(key % n == k, 2.0).otherwise(1.0)
    second = products.filter(key % 3 != 0).select("product_id", "brand", price(7, 2).alias("retail_price"))
    third = products.select("product_id", F.when(key % 11 != 4, F.col("brand")).alias("brand"), price(14, 2).alias("retail_price"))
    return [products, second, third]


def _history(name: str, key: str, snapshots) -> QueryFn:
    def q(spark, sf_dir):
        configure(spark)
        root, out = work_dir(spark, name), None
        steps = list(zip(snapshots(spark, sf_dir), HISTORY_BATCHES, strict=True))
        for snapshot, (batch, at) in [steps[0], steps[1], steps[1], steps[2], steps[0]]:  # batches come again
            out = history.apply_snapshot(snapshot, root, key, batch, F.lit(at).cast("timestamp_ntz"))
        return out
    q.__name__ = f"q_{name}"
    return q


register("history_users")(_history("history_users", "customer_id", _user_snapshots))
register("history_products")(_history("history_products", "product_id", _product_snapshots))


# --- as-of join -----------------------------------------------------------------------------


@register("asof_last_purchase")
def q_asof_last_purchase(spark, sf_dir):
    """Every event with its customer's last purchase until then; anonymous events have none."""
    configure(spark)
    events = clean_build(spark, sf_dir).staged["stg_events"].select("event_id", "customer_id", "event_type", "created_at")
    return asof.as_of_join(events, events.filter(F.col("event_type") == "purchase"), key="customer_id", instant="created_at", version_key="customer_id",
                           valid_from="created_at", values={"event_id": "purchase_event_id", "created_at": "purchased_at"})


@register("asof_product_version")
def q_asof_product_version(spark, sf_dir):
    """Every order item with its product's version of then; the history is moved back 28 years, into the time of the items."""
    configure(spark)
    past = lambda c: F.expr(f"{c} - INTERVAL 28 YEARS").alias(c)
    products = REGISTRY["history_products"](spark, sf_dir).select("product_id", "brand", "retail_price", "from_batch", past("valid_from"), past("valid_to"))
    items = clean_build(spark, sf_dir).staged["stg_order_items"].select("order_item_id", "product_id", "created_at", "sale_price")
    return asof.as_of_join(items, products, key="product_id", instant="created_at", version_key="product_id", valid_from="valid_from", valid_to="valid_to",
                           values={"brand": "brand", "retail_price": "list_price", "from_batch": "version_batch"})


# --- cube with exact distinct counts -------------------------------------------------------------


@register("sales_cube")
def q_sales_cube(spark, sf_dir):
    """Items, distinct customers, orders and products, and money, of every combination of status, year and month."""
    configure(spark)
    fact = built_tables(spark, sf_dir).fct_order_items.select(
        "order_item_status", F.year("order_date").cast("long").alias("order_year"), F.month("order_date").cast("long").alias("order_month"), "customer_id", "order_id", "product_id",
        "item_amount")
    return cubes.sales_cube(fact, ["order_item_status", "order_year", "order_month"],
                            {"customer_id": "customer_count", "order_id": "order_count", "product_id": "product_count"}, {"item_amount": "ordered_item_amount"})


# --- event-time windows ---------------------------------------------------------------------------

WINDOWS = {"instant": "CREATED_AT", "keys": ["EVENT_TYPE"], "width": "6 hours"}
WINDOW_DELAY = "12 hours"


def _event_windows(spark, sf_dir):
    """Four passes, each a restart, over events that come by eight-day slices; some come one or two slices late."""
    configure(spark)
    work = work_dir(spark, "event-windows")
    events = _stamped(spark, sf_dir, "events", SELECTED_BATCH).select("ID", "CREATED_AT", "EVENT_TYPE")
    late = F.when(F.col("ID") % 50 == 7, 1).when(F.col("ID") % 211 == 5, 2).otherwise(0)
    arrives = F.least(F.lit(3), F.expr("datediff(CREATED_AT, DATE'2024-01-01') div 8") + late)
    sliced = events.withColumn("arrives", arrives)
    for k in range(4):
        sliced.filter(F.col("arrives") == k).drop("arrives").write.parquet(f"{work}/landing/{k}")
        event_windows.run_pass(spark, f"{work}/landing", events.schema, f"{work}/windows", f"{work}/checkpoint", delay=WINDOW_DELAY, **WINDOWS)
    return spark.read.schema(events.schema).parquet(f"{work}/landing/*"), event_windows.closed_windows(spark, f"{work}/windows", events.schema, **WINDOWS)


def _lower_names(df):
    return utc_wall_clock(df).select(*[F.col(c).alias(c.lower()) for c in df.columns])


@register("event_windows")
def q_event_windows(spark, sf_dir):
    """Events per type and six hours, of the windows that the watermark has closed."""
    return _lower_names(_event_windows(spark, sf_dir)[1])


@register("event_windows_late")
def q_event_windows_late(spark, sf_dir):
    """Closed windows that events came too late for, and how many."""
    delivered, closed = _event_windows(spark, sf_dir)
    return _lower_names(event_windows.late_rows(delivered, closed, delay=WINDOW_DELAY, **WINDOWS))


# --- ordered funnel ---------------------------------------------------------------------------

FUNNEL_STEPS = ["signup", "view", "click", "purchase"]
FUNNEL_SECONDS = 5 * 86400


def _funnel(spark, sf_dir):
    configure(spark)
    events = clean_build(spark, sf_dir).staged["stg_events"].select("event_id", "customer_id", "created_at", "event_type")
    return funnel.funnel_progress(events, FUNNEL_STEPS, limit_seconds=FUNNEL_SECONDS, keys=["customer_id"])


@register("funnel_events")
def q_funnel_events(spark, sf_dir):
    """Every event with the furthest step that it reaches within five days of a sign-up; anonymous events are one long sequence."""
    return _funnel(spark, sf_dir)


@register("funnel_customers")
def q_funnel_customers(spark, sf_dir):
    return funnel.funnel_by_key(_funnel(spark, sf_dir), ["customer_id"], len(FUNNEL_STEPS))


@register("funnel_report")
def q_funnel_report(spark, sf_dir):
    return funnel.funnel_report(funnel.funnel_by_key(_funnel(spark, sf_dir), ["customer_id"], len(FUNNEL_STEPS)), FUNNEL_STEPS)


# --- top k per group ----------------------------------------------------------------------------


@register("top_products_by_day")
def q_top_products_by_day(spark, sf_dir):
    """The three products of each category and day that sold for most."""
    configure(spark)
    b = built_tables(spark, sf_dir)
    products = b.dim_products.select("product_id", "category")
    sold = (b.fct_order_items.join(products, "product_id").groupBy("category", "order_date", "product_id")
            .agg(F.sum("item_amount").cast("decimal(38,4)").alias("ordered_item_amount"), F.count(F.lit(1)).alias("item_count")))
    return topk.top_k(sold, ["category", "order_date"], {"ordered_item_amount": True, "product_id": False}, 3)


@register("top_items_by_status")
def q_top_items_by_status(spark, sf_dir):
    """The dearest items of each status, to the tenth place and with all ties; a few statuses hold all rows."""
    configure(spark)
    items = built_tables(spark, sf_dir).fct_order_items.select("order_item_status", "order_item_id", F.round("item_amount", -3).alias("rounded_amount"))
    return topk.top_k(items, ["order_item_status"], {"rounded_amount": True}, 10, ties=True)


# --- stored sketches ------------------------------------------------------------------------------


@register("sketch_bounds")
def q_sketch_bounds(spark, sf_dir):
    """Distinct customers and quantiles of amounts by month, from a stored table of daily sketches: exact count, and whether each estimate keeps its bound."""
    configure(spark)
    fact = built_tables(spark, sf_dir).fct_order_items.select("order_date", F.trunc("order_date", "month").alias("order_month"), "customer_id",
                                                              F.col("item_amount").cast("double").alias("amount"))
    stored = f"{work_dir(spark, 'sketches')}/by_day"
    sketches.daily_sketches(fact, ["order_date", "order_month"], ["customer_id"], ["amount"]).write.parquet(stored)
    by_month = sketches.merged(spark.read.parquet(stored), ["order_month"], ["customer_id"], ["amount"])
    return sketches.measured(fact, sketches.estimates(by_month, ["order_month"], ["customer_id"], ["amount"]), "order_month", "customer_id", "amount")


# --- incremental fact and mart ------------------------------------------------------------

_INCREMENTAL: dict[tuple, tuple] = {}


def _incremental(spark, sf_dir):
    """Three batches of changed rows, two of them applied again: the whole extract; orders three days later, cancelled items, dearer units;
    items that move to an unknown order (a day of their own, without a date)."""
    configure(spark)
    key = (spark.sparkContext.applicationId, _sources(spark, sf_dir), "incremental")
    with _LOCK:
        if key not in _INCREMENTAL:
            _INCREMENTAL[key] = _incremental_run(spark, sf_dir)
        return _INCREMENTAL[key]


def _incremental_run(spark, sf_dir):
    first = clean_build(spark, sf_dir).staged
    models = ("stg_order_items", "stg_orders", "stg_inventory_items")
    batch = lambda df, k: df.withColumn("source_batch_id", F.lit(HISTORY_BATCHES[k][0]))
    items = first["stg_order_items"]
    cancelled = F.when(F.col("order_item_id") % 7 == 2, "cancelled").otherwise(F.col("order_item_status"))
    steps = [{m: first[m] for m in models},
             {"stg_order_items": batch(items.filter("order_item_id % 7 = 2").withColumn("order_item_status", cancelled), 1),
              "stg_orders": batch(first["stg_orders"].filter("order_id % 5 = 1").withColumn("created_at", F.col("created_at") + F.expr("INTERVAL 3 DAYS")), 1),
              "stg_inventory_items": batch(first["stg_inventory_items"].filter("inventory_item_id % 11 = 3").withColumn("cost", F.col("cost") * 2.0), 1)},
             {"stg_order_items": batch(items.filter("order_item_id % 13 = 4").withColumn("order_item_status", cancelled).withColumn("order_id", F.lit(-1).cast("bigint")), 2)}]
    root, upto = work_dir(spark, "incremental"), {}
    for k in (0, 1, 1, 2, 0):
        for m, df in steps[k].items() if HISTORY_BATCHES[k][0] not in upto.get("seen", ()) else ():
            upto[m] = upto[m].unionByName(df) if m in upto else df
        upto["seen"] = (*upto.get("seen", ()), HISTORY_BATCHES[k][0])
        incremental.apply_batch(spark, root, {m: upto[m] for m in models}, HISTORY_BATCHES[k][0])
    return root, incremental.full_build({m: upto[m] for m in models})


@register("incremental_fact")
def q_incremental_fact(spark, sf_dir):
    root, (fact, _) = _incremental(spark, sf_dir)
    return incremental.read_table(spark, f"{root}/fct_order_items", fact)


@register("incremental_mart")
def q_incremental_mart(spark, sf_dir):
    root, (_, mart) = _incremental(spark, sf_dir)
    return incremental.read_table(spark, f"{root}/mart_daily_sales", mart)


# --- late deliveries -----------------------------------------------------------------------

@register("land_late_deliveries")
def q_land_late_deliveries(spark, sf_dir):
    """RAW contents of one batch of orders that comes in two parts, by four ways: into a store without a ledger, as late rows, in a second
    folder, and in a folder that is marked only after a first pass. Every way the first part comes again."""
    configure(spark)
    work = work_dir(spark, "late-deliveries")
    whole = _stamped(spark, sf_dir, "orders", SELECTED_BATCH)
    even, odd = whole.filter("ORDER_ID % 2 = 0"), whole.filter("ORDER_ID % 2 = 1")
    landing.append_raw(even, f"{work}/no ledger", "orders")
    for rows in (odd, odd):
        landing.append_new_batches(spark, rows, f"{work}/no ledger", "orders")
    for rows in (even, odd, even):
        landing.append_new_batches(spark, rows, f"{work}/late rows", "orders")
    for path, marked in (("second folder", True), ("waiting folder", False)):
        zone, marks = f"{work}/{path}-landing", f"{work}/{path}-marks"
        run = lambda: landing_stream.run_landing(spark, zone, f"{work}/{path}", {"orders": whole.schema}, f"{work}/{path}-checkpoints", marks)  # noqa: B023, E731
        landing_stream.land_files(even, zone, "orders", SELECTED_BATCH)
        if marked:
            spark.range(1).write.json(f"{marks}/{SELECTED_BATCH}")
        run()
        landing_stream.land_files(odd, zone, "orders", f"{SELECTED_BATCH}-more")
        landing_stream.land_files(even, zone, "orders", f"{SELECTED_BATCH}-again")
        run()
        if not marked:
            spark.range(1).write.json(f"{marks}/{SELECTED_BATCH}")
        run()
    parts = [utc_wall_clock(read_raw_like(spark, f"{work}/{path}/orders", whole.schema)).select(F.lit(path).alias("load_path"), "*")
             for path in ("no ledger", "late rows", "second folder", "waiting folder")]
    return checks.union_all(parts)

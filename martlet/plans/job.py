"""The batch build as one Spark application: RAW store -> tables -> checks.

``build_and_check`` is the equivalent of building the two dimensions, the
fact and the mart for one selected batch (staging stays lazy, like views),
then running the declared checks and the four reconciliations against the
written tables. Independent actions are submitted together from a few
driver threads, as the original ran independent nodes on 4 threads; Spark
schedules the concurrent jobs on the same executors:

1. ``dim_customers``, ``dim_products`` and ``fct_order_items`` are written
   concurrently (full refresh);
2. ``mart_daily_sales`` is aggregated from the *written* fact;
3. the declared checks (one job) and the four reconciliations run concurrently on the written
   tables; their per-test failure counts (one row per declared test) are
   written as ``check_results``.

Every step reads Parquet written by the previous one, so a lost executor
recomputes at most one step's tasks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.config import DECLARED_TESTS, TABLES
from martlet.functions.batch_ids import require_batch_id
from martlet.operators import checks, reconcile
from martlet.plans import marts
from martlet.plans.batch_build import Build, build, materialize
from martlet.session import run_concurrently
from martlet.sources import versions
from martlet.sources.landing import assert_loadable, batch_manifest, complete_batches, read_raw


def register_views(b: Build, prefix: str = "") -> list[str]:
    """Expose every model as a temp view (lazy, re-evaluated on read) for SQL users."""
    names = []
    for name, df in b.models().items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names


class CheckFailure(RuntimeError):
    """Declared checks or reconciliations failed; ``totals`` has the failures per family."""

    def __init__(self, batch_id: str, totals: dict[str, int]):
        super().__init__(f"batch {batch_id} fails its checks: { {k: n for k, n in totals.items() if n} }")
        self.totals = totals


PUBLISHED = ("dim_customers", "dim_products", "fct_order_items", "mart_daily_sales")


def published(spark: SparkSession, out_root: str) -> dict[str, DataFrame]:
    """The published tables and their ``check_results``, all of one build; nothing before the first."""
    _, state = versions.current(spark, out_root)
    return {name: spark.read.parquet(f"{out_root}/{folder}") for name, folder in state.get("tables", {}).items()}


def build_and_check(spark: SparkSession, raw: dict[str, DataFrame], out_root: str, batch_id: str,
                    declared: dict = DECLARED_TESTS, workers: int = 4, fail_on_errors: bool = True) -> dict[str, int]:
    """Build the four tables for one batch, check them, publish them; failures per check family.

    Tables are written under ``out_root/_runs/<run>``, checked there and stay there. Then one pointer file makes all of them
    current at once (``published`` reads them by it): whatever fails before leaves the old set whole, and of two builds that began from
    the same version only the first is published. With ``fail_on_errors`` a failed check raises ``CheckFailure`` and publishes nothing.
    """
    require_batch_id(batch_id)
    live_root, run = out_root, f"_runs/{uuid.uuid4().hex}"
    out_root = f"{live_root}/{run}"
    began_from, _ = versions.current(spark, live_root)
    staged_build = build(raw, batch_id)
    out = run_concurrently({name: (lambda n=name: materialize(getattr(staged_build, n), f"{out_root}/{n}"))
                            for name in ("dim_customers", "dim_products", "fct_order_items")}, workers)
    out["mart_daily_sales"] = materialize(marts.mart_daily_sales(out["fct_order_items"]),
                                          f"{out_root}/mart_daily_sales")
    b = build(raw, batch_id, fct=out["fct_order_items"], mart=out["mart_daily_sales"])
    s = b.staged
    models = {**{m: s[m] for m in s.keys()}, **out}
    singular = {
        "dimension_coverage": lambda: reconcile.dimension_coverage(
            s["stg_users"], out["dim_customers"], s["stg_products"], out["dim_products"]),
        "fact_reconciliation": lambda: reconcile.fact_reconciliation(
            out["fct_order_items"], s["stg_order_items"], s["stg_orders"], s["stg_inventory_items"]),
        "order_quantities": lambda: reconcile.order_quantities(s["stg_orders"], out["fct_order_items"]),
        "daily_reconciliation": lambda: reconcile.daily_reconciliation(
            reconcile.daily_expected(s["stg_order_items"], s["stg_orders"], s["stg_inventory_items"]),
            out["mart_daily_sales"]),
    }
    # Only per-test summaries reach the driver: one row per declared test, one count per reconciliation.
    generic = checks.check_summary(models, raw, batch_id, declared)
    actions = {"generic": lambda: [tuple(r) for r in generic.collect()]}
    actions.update({name: (lambda f=fn: f().count()) for name, fn in singular.items()})
    results = run_concurrently(actions, workers)
    rows = results.pop("generic")
    rows += [("singular", name, None, int(n)) for name, n in results.items()]
    table = spark.createDataFrame(rows, "test_name string, model string, column_name string, failures bigint")
    table.select(F.lit(batch_id).alias("batch_id"), "*").write.mode("overwrite").parquet(f"{out_root}/check_results")
    totals: dict[str, int] = {}
    for test_name, _m, _c, failures in rows:
        totals[test_name] = totals.get(test_name, 0) + int(failures)
    if fail_on_errors and any(totals.values()):
        raise CheckFailure(batch_id, totals)
    versions.publish(spark, live_root, {"batch_id": batch_id, "tables": {name: f"{run}/{name}" for name in (*PUBLISHED, "check_results")}}, after=began_from)
    return totals


def build_batch(spark: SparkSession, raw_root: str, out_root: str, batch_id: str,
                tables: tuple[str, ...] = TABLES, workers: int = 4,
                require_complete: bool = True, fail_on_errors: bool = True) -> dict[str, int]:
    """Build and check one batch read from a ``_BATCH_ID``-partitioned RAW store.

    With ``require_complete`` (the default) the batch must first be complete in the RAW
    manifest (every expected table landed, none empty): tables are committed
    one by one, so a batch is only selectable once all of them are in.
    """
    raw = {t: read_raw(spark, raw_root, t) for t in tables}
    if require_complete:
        assert_loadable(complete_batches(batch_manifest(raw), tables), batch_id)
    return build_and_check(spark, raw, out_root, batch_id, workers=workers, fail_on_errors=fail_on_errors)

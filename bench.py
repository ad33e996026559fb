"""Benchmark the headline queries and print ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed in full with the ``noop`` sink (no driver collect) and
timed as the best of three runs (steady state). ``staging_build`` and
``sales_build`` reproduce the shape of the reference's two published build
timings: 7 staging views + 58 tests, and 4 written tables + 34 tests. JVM start-up and one warm-up pass are excluded. Deriving the RAW fixture from
the driver tables and landing it (the reference's extract/load step, which its
build timings also exclude) and writing the fact tables are reported under
``setup``; ``value`` is the sum of the per-query times.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from martlet.catalog import REGISTRY, built_tables, clean_build, stored_raw  # noqa: E402
from martlet.config import DECLARED_TESTS  # noqa: E402
from martlet.operators import checks  # noqa: E402
from martlet.sources.driver_tables import SELECTED_BATCH  # noqa: E402
from martlet.plans import marts  # noqa: E402
from martlet.plans.job import build_and_check  # noqa: E402
from martlet.session import build_session, work_dir  # noqa: E402

HEADLINE = [
    "fct_order_items", "mart_daily_sales", "dim_customers", "dim_products", "sales_kpis",
    "stg_events", "check_summary", "check_unique", "check_relationships",
    "recon_fact", "recon_daily", "recon_order_quantities", "recon_dimension_coverage",
    "profile_keys", "profile_null_counts", "profile_orphans", "profile_user_mismatch",
    "land_complete_batches",
]


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def staging_build(spark, sf_dir) -> int:
    """The reference's staging build: 7 staging views + their 58 declared tests
    in one job."""
    b = clean_build(spark, sf_dir)
    declared = {m: spec for m, spec in DECLARED_TESTS.items() if m.startswith("stg_")}
    return len(checks.check_summary(b.models(), b.raw, SELECTED_BATCH, declared).collect())


def sales_build(spark, sf_dir) -> int:
    """The reference's sales build: 4 tables written (dims, fact, mart from the
    written fact) + their 30 declared tests + the 4 singular reconciliations,
    independent actions submitted concurrently (``plans.job.build_and_check``)."""
    b = clean_build(spark, sf_dir)
    declared = {m: spec for m, spec in DECLARED_TESTS.items() if not m.startswith("stg_")}
    totals = build_and_check(spark, b.raw, work_dir(spark, "bench-build"), SELECTED_BATCH, declared,
                             fail_on_errors=False)  # the fixture has unknown event types
    return sum(totals.values())


def single_tests(spark, sf_dir) -> dict:
    """Single-model timings shaped like the reference's per-node figures."""
    b = built_tables(spark, sf_dir)
    s = b.staged
    return {
        # mart aggregated from the written fact table (the reference's mart reads its fact table)
        "mart_from_fact_table": lambda: run_noop(marts.mart_daily_sales(b.fct_order_items)),
        "unique_order_item_id": lambda: run_noop(checks.unique("stg_order_items", s["stg_order_items"],
                                                               "order_item_id")),
        "relationships_events_customers": lambda: run_noop(checks.relationships(
            "stg_events", s["stg_events"], "customer_id", "stg_users", s["stg_users"], "customer_id")),
        "row_count_events": lambda: run_noop(checks.batch_row_count(
            "stg_events", s["stg_events"], "events", b.raw["events"], SELECTED_BATCH)),
    }


def best_of(n: int, fn) -> float:
    best = float("inf")
    for _ in range(n):
        t = time.perf_counter()
        fn()
        best = min(best, time.perf_counter() - t)
    return round(best, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus),
                          extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    setup, times = {}, {}
    t = time.perf_counter()
    for faulty in (False, True):  # RAW fixture -> _BATCH_ID-partitioned Parquet, once
        stored_raw(spark, sf_dir, faulty=faulty)
    setup["land_raw_fixture"] = round(time.perf_counter() - t, 3)
    t = time.perf_counter()
    for faulty in (False, True):  # fact written once; checks/reconciliations read the table
        built_tables(spark, sf_dir, faulty=faulty)
    setup["write_fact_tables"] = round(time.perf_counter() - t, 3)
    run_noop(REGISTRY["mart_daily_sales"](spark, sf_dir))  # warm-up: JIT, file listing caches
    for name in HEADLINE:
        times[name] = best_of(3, lambda: run_noop(REGISTRY[name](spark, sf_dir)))
    for name, fn in single_tests(spark, sf_dir).items():
        times[name] = best_of(3, fn)
    times["staging_build"] = best_of(3, lambda: staging_build(spark, sf_dir))
    times["sales_build"] = best_of(3, lambda: sales_build(spark, sf_dir))
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "setup": setup, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus}))


if __name__ == "__main__":
    main()

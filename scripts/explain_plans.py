"""Write PLANS.md: the at-scale physical plan shape of the headline queries.

Broadcast joins are disabled here (as they would be for large sides on a
cluster), so the trees show the shuffle structure Catalyst chooses for big
inputs. For each query: the operator tree, the number of shuffles, the join
strategies and the scan pruning (partition filters, read schema width).

    python scripts/explain_plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from martlet.catalog import REGISTRY  # noqa: E402
from martlet.session import build_session  # noqa: E402

QUERIES = ["stg_orders", "fct_order_items", "mart_daily_sales", "sales_kpis", "check_relationships", "check_unique",
           "check_summary", "recon_fact", "recon_daily", "recon_order_quantities", "recon_dimension_coverage",
           "profile_orphans", "profile_user_mismatch", "profile_batch", "land_complete_batches"]


TREES = {"fct_order_items", "mart_daily_sales", "check_relationships", "recon_fact", "recon_daily",
         "profile_user_mismatch"}
JOIN = re.compile(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)"
                  r"\b.*?\b(Inner|LeftOuter|RightOuter|FullOuter|LeftAnti|LeftSemi|Cross)\b")


GUIDE = """How to read them:

- `stg_*`: no shuffle. One Parquet scan with `PartitionFilters: [_BATCH_ID = ...]` and only the staged columns.
- `fct_order_items`: two sort-merge left joins keyed `(id, batch)`, so 4 exchanges: items by order id,
  orders, the joined items by inventory id, and inventory. The orders side reads 2 columns and the inventory
  side 2.
- `mart_daily_sales`: the fact's 4 exchanges plus the two-level distinct aggregate. `Expand` feeds a partial
  aggregate keyed by (day, batch, distinct key), then partial counts are shuffled by (day, batch), so a hot
  day never sits in one task.
- `check_*`: per model one scan. Aggregates are partial first; relationships anti-join pre-aggregated
  `(column, value, n)` child rows against the tagged union of parent keys.
- `recon_fact`: the full outer join as a left join plus an anti join on the fact's distinct keys, then two
  left joins. Every join is one AQE can split when a key is hot.
- "Single-partition merges" only combine one partial aggregate row per task (global counts).
"""


def tree(df) -> str:
    text = df._jdf.queryExecution().executedPlan().treeString()
    return "\n".join(re.sub(r"#\d+L?|, \[plan_id=\d+\]", "", line)[:150] for line in text.splitlines() if line.strip())


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(master="local[*]", shuffle_partitions=8, extra={"spark.sql.autoBroadcastJoinThreshold": "-1",
                                                       "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    spark.sparkContext.setLogLevel("ERROR")
    print("# Physical plan shapes (broadcast disabled, i.e. every join planned for large inputs)\n")
    print(f"Generated by `scripts/explain_plans.py` on `{os.path.basename(sf_dir)}`; the shapes do not depend on "
          "the scale factor.\n")
    print(GUIDE)
    for name in QUERIES:
        df = REGISTRY[name](spark, sf_dir)
        plan = tree(df)
        shuffles = len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning", plan))
        singles = plan.count("Exchange SinglePartition")
        full = df._jdf.queryExecution().executedPlan().treeString()
        joins = sorted(set(JOIN.findall(full)))
        formatted = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        pfilters = len(re.findall(r"PartitionFilters: \[[^\]]+\]", formatted))
        scans = len(re.findall(r"^\(\d+\) Scan parquet", formatted, flags=re.M))
        widths = [s.count(":") for s in re.findall(r"ReadSchema: struct<([^\n]*)>", formatted)]
        print(f"## `{name}`\n")
        print(f"- hash/range shuffles: {shuffles}; single-partition merges of partial aggregates: {singles}")
        print(f"- joins: {', '.join(' '.join(j).strip() for j in joins) or 'none'}")
        print(f"- parquet scans: {scans}, with partition filters: {pfilters}; columns read per scan: {widths}\n")
        if name in TREES:
            print("```")
            print(plan)
            print("```\n")


if __name__ == "__main__":
    main()

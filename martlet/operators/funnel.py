"""Ordered funnel: how far each sequence of events gets through a list of steps, in order and within a time limit from its first step.

A row of step j goes on from the latest first step that reached step j - 1 before it: a later start leaves more time, so earlier ones need not be kept,
and the state of a sequence is one instant per step, whatever its length. Starts only grow along a sequence, so a step's state is the last
start seen. Sequences are dealt by ranges of (keys, instant, event id), as sessions are, so anonymous events, a third of all, spread over many tasks;
per step, a range hands at most one start on to the next, for the sequence that crosses its border.

Defined cases: a row is after another if its (instant, event id, kind) is greater, nulls first, so rows alike in all three do not follow each other on purpose but one of
them may; a step at exactly the limit counts; a kind may stand in several steps, and a row then counts for the furthest; a null key is a key like any other;
rows without an instant reach no step; repeated rows are kept; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlet.operators.sessions import _handed_on, _stitch, _written

FIGURES = ("funnel_step", "funnel_started_at")


def funnel_progress(events: DataFrame, steps: list[str], *, limit_seconds: int, keys: list[str], instant: str = "created_at", event: str = "event_id",
                    kind: str = "event_type") -> DataFrame:
    """``events`` with the furthest step (from 1) that each row reaches and the start it goes back to, null for rows that reach none."""
    if not steps or {c.lower() for c in FIGURES} & {c.lower() for c in events.columns}:
        raise ValueError(f"a funnel needs steps, and rows without the columns {FIGURES}")
    packed = events.select(F.struct(*keys).alias("k"), F.col(instant).alias("at"), F.col(event).alias("event"), F.col(kind).alias("kind"),
                           F.struct(*[F.col(c) for c in events.columns]).alias("own"))
    order = [F.col("at"), F.col("event").asc_nulls_first(), F.col("kind").asc_nulls_first()]
    dealt = _written(packed.filter(F.col("at").isNotNull()).withColumn("number", F.monotonically_increasing_id())
                     .repartitionByRange("k", *order, "number").withColumn("part", F.spark_partition_id()), "funnel")
    earlier = Window.partitionBy("part", "k").orderBy(*order, "number").rowsBetween(Window.unboundedPreceding, -1)
    in_time = F.col("at") <= F.col("before") + F.expr(f"INTERVAL {int(limit_seconds)} SECONDS")
    rows = dealt.withColumns({"before": F.col("at"), **{f: F.lit(None).cast(t) for f, t in zip(FIGURES, ("int", "timestamp_ntz"))}})
    for step, wanted in enumerate(steps, 1):
        rows = rows.withColumn("start", F.when((F.col("kind") == wanted) & in_time, F.col("before")))
        rows = rows.withColumns({FIGURES[0]: F.when(F.col("start").isNotNull(), step).otherwise(F.col(FIGURES[0])),
                                 FIGURES[1]: F.coalesce("start", FIGURES[1])})
        if step < len(steps):
            handed = _handed_on(rows.groupBy("part", "k").agg(F.max("start").alias("latest")), "k", handed=F.max("latest"))
            within = rows.withColumn("within", F.last("start", ignorenulls=True).over(earlier))
            rows = _stitch(within, handed, "k").withColumn("before", F.coalesce("within", "handed")).drop("within", "handed", "start")
    untimed = events.filter(F.col(instant).isNull())
    found = rows.select("own.*", *FIGURES)
    return found.unionByName(untimed.select("*", *[F.lit(None).cast(found.schema[f].dataType).alias(f) for f in FIGURES]))


def funnel_by_key(progress: DataFrame, keys: list[str], last_step: int, *, instant: str = "created_at") -> DataFrame:
    """One row per sequence: furthest step (0 for none), starts, completions, first completion, seconds of the fastest one.

    Combined map-side, so a sequence of any length sends one row per task.
    """
    done = F.col(FIGURES[0]) == last_step
    seconds = F.unix_micros(F.col(instant).cast("timestamp")) - F.unix_micros(F.col(FIGURES[1]).cast("timestamp"))
    return progress.groupBy(*keys).agg(
        F.coalesce(F.max(FIGURES[0]), F.lit(0)).alias("furthest_step"), F.count_if(F.col(FIGURES[0]) == 1).alias("start_count"),
        F.count_if(done).alias("completion_count"), F.min(F.when(done, F.col(instant))).alias("first_completed_at"),
        F.min(F.when(done, seconds)).alias("fastest_microseconds"))


def funnel_report(by_key: DataFrame, steps: list[str]) -> DataFrame:
    """Per step: sequences that reach it, and those that stop there. One aggregate over the sequences."""
    furthest = F.col("furthest_step")
    one = by_key.agg(F.array(*[F.struct(F.lit(j).alias("step"), F.lit(s).alias("step_name"), F.count_if(furthest >= j).alias("reached_count"),
                                        F.count_if(furthest == j).alias("stopped_count")) for j, s in enumerate(steps, 1)]).alias("steps"))
    return one.select(F.inline("steps"))

"""Event sessions by inactivity gap, as a segmented scan over range partitions.

A customer's events in order of (instant, event id) belong to one session until a pause longer than the gap. Anonymous events (no
customer) are one sequence like any other, and may be a third of all events, so no sequence is gathered in one task: events are
dealt by ranges of (customer, instant, event id), scanned within each range, and stitched. What a range hands on to the next (last
instant, open session, sessions so far) concerns only the customer whose events go on across the border, so the
broadcast tables have at most one row per range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.session import work_dir

GAP_SECONDS = 1800
FIGURES = ("session_number", "session_started_at", "session_first_event_id")


def _written(df: DataFrame, purpose: str) -> DataFrame:
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _handed_on(edges: DataFrame, customer: str, **values: Column) -> DataFrame:
    """Per range and customer, what its earlier ranges hand on; only rows that have an earlier range."""
    before = Window.partitionBy(customer).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return (edges.select("part", customer, F.count(F.lit(1)).over(before).alias("earlier"), *[v.over(before).alias(k) for k, v in values.items()])
            .filter("earlier > 0").drop("earlier"))


def _stitch(rows: DataFrame, handed: DataFrame, customer: str) -> DataFrame:
    """``rows`` with what was handed on to their range, null where nothing was."""
    other = handed.withColumnsRenamed({"part": "at_part", customer: "of_customer"})
    same = (F.col("part") == F.col("at_part")) & F.col(customer).eqNullSafe(F.col("of_customer"))
    return rows.join(F.broadcast(other), same, "left").drop("at_part", "of_customer")


def event_sessions(events: DataFrame, *, customer: str = "customer_id", instant: str = "created_at", event: str = "event_id",
                   gap_seconds: int = GAP_SECONDS) -> DataFrame:
    """``events`` with the number of the session among the customer's own (from 1), its first instant and its first event.

    Events without an instant are in no session and keep null figures. Events alike in customer, instant and id are in the same session.
    """
    order = [F.col(instant), F.col(event).asc_nulls_first()]
    timed = events.filter(F.col(instant).isNotNull())
    dealt = _written(timed.withColumn("row", F.monotonically_increasing_id())
                     .repartitionByRange(F.col(customer).asc_nulls_first(), *order, "row")
                     .withColumn("part", F.spark_partition_id()).drop("row"), "sessions")
    last = _handed_on(dealt.groupBy("part", customer).agg(F.max(instant).alias("last_at")), customer, last_at=F.max("last_at"))
    within = Window.partitionBy("part", customer).orderBy(*order)
    so_far = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = _stitch(dealt.withColumn("previous_at", F.lag(instant).over(within)), last, customer)
    previous = F.coalesce("previous_at", "last_at")
    opens = previous.isNull() | (F.col(instant) > previous + F.expr(f"INTERVAL {int(gap_seconds)} SECONDS"))
    start = F.when(opens, F.struct(F.col(instant).alias("at"), F.col(event).alias("event")))
    scanned = _written(marked.withColumn("start", start).drop("previous_at", "last_at")
                       .withColumns({"own": F.count("start").over(so_far), "open": F.last("start", ignorenulls=True).over(so_far)}).drop("start"), "sessions")
    edges = scanned.groupBy("part", customer).agg(F.max("own").alias("own"), F.max("open").alias("open"))
    handed = _handed_on(edges, customer, own_before=F.sum("own"), open_before=F.max("open"))
    session = F.coalesce("open", "open_before")
    figures = [(F.col("own") + F.coalesce("own_before", F.lit(0))).alias(FIGURES[0]), session["at"].alias(FIGURES[1]), session["event"].alias(FIGURES[2])]
    found = _stitch(scanned, handed, customer).select(*events.columns, *figures)
    untimed = events.filter(F.col(instant).isNull())
    return found.unionByName(untimed.select("*", *[F.lit(None).cast(found.schema[c].dataType).alias(c) for c in FIGURES]))


def session_summary(sessions: DataFrame, *, customer: str = "customer_id", instant: str = "created_at", kind: str = "event_type") -> DataFrame:
    """One row per session: events, purchases, first and last instant, length in seconds. Combined map-side, so a session of any size is spread over tasks."""
    found = sessions.filter(F.col("session_number").isNotNull()).groupBy(customer, "session_number").agg(
        F.min(instant).alias("session_started_at"), F.max(instant).alias("session_ended_at"), F.count(F.lit(1)).alias("event_count"),
        F.count_if(F.col(kind) == "purchase").alias("purchase_count"))
    seconds = F.unix_seconds(F.col("session_ended_at").cast("timestamp")) - F.unix_seconds(F.col("session_started_at").cast("timestamp"))
    return found.withColumn("duration_seconds", seconds)

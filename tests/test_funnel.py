"""Ordered funnel against trying every chain of events, with one sequence of a third of all rows."""

from datetime import datetime, timedelta
from itertools import groupby

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from martlet.operators import funnel

SCHEMA = "event_id long, customer_id long, created_at timestamp_ntz, event_type string, k string, at int"
START = datetime(2026, 1, 1)
minute = lambda m: START + timedelta(minutes=m)


def chains(before, steps, limit):
    """All starts of chains through ``steps`` that end right after the rows ``before``, by trying every choice."""
    if not steps:
        return [None]
    return [(s or row[2]) for n, row in enumerate(before) if row[3] == steps[-1]
            for s in chains(before[:n], steps[:-1], limit) if s is None or row[2] - s <= limit]


def brute(rows, steps, seconds):
    limit, out = timedelta(seconds=seconds), []
    order = lambda r: (r[2], r[0] is not None, r[0] or 0, r[3] is not None, r[3] or "")
    by_key = lambda r: (r[1] is not None, r[1] or 0)
    timed = [r for r in rows if r[2] is not None]
    for _, group in groupby(sorted(timed, key=by_key), by_key):
        group = sorted(group, key=order)
        for n, row in enumerate(group):
            best = (None, None)
            for j, step in enumerate(steps, 1):
                if row[3] == step:
                    starts = [row[2]] if j == 1 else [s for s in chains(group[:n], steps[:j - 1], limit) if row[2] - s <= limit]
                    if starts:
                        best = (j, max(starts))
            out.append((*row, *best))
    return sorted(out + [(*r, None, None) for r in rows if r[2] is None], key=str)


def fast(rows, steps, seconds):
    """One pass with one start per step, for inputs too long to try every chain."""
    latest, out = {}, []
    for row in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[0])):
        state, best = latest.setdefault(row[1], [None] * len(steps)), (None, None)
        for j in reversed(range(len(steps))):
            start = row[2] if j == 0 else state[j - 1]
            if row[3] == steps[j] and start is not None and row[2] - start <= timedelta(seconds=seconds):
                state[j] = start
                best = max(best, (j + 1, start)) if best[0] else (j + 1, start)
        out.append((*row, *best))
    return sorted(out, key=str)


def got(spark, rows, steps, seconds):
    found = funnel.funnel_progress(spark.createDataFrame([tuple(r) for r in rows], SCHEMA).repartition(3), steps, limit_seconds=seconds, keys=["customer_id"])
    assert found.columns == ["event_id", "customer_id", "created_at", "event_type", "k", "at", *funnel.FIGURES]
    return sorted(map(tuple, found.collect()), key=str)


ROWS = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.one_of(st.none(), st.integers(1, 2)), st.one_of(st.none(), st.integers(0, 10).map(minute)),
                          st.one_of(st.none(), st.sampled_from("abc")), st.just("own"), st.just(7)), max_size=18, unique_by=lambda r: r[:4])


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(ROWS, st.sampled_from(["abc", "ab", "aba", "a", "aab"]), st.sampled_from([0, 180, 420, 6000]))
def test_random_events(spark, rows, steps, seconds):
    assert got(spark, rows, list(steps), seconds) == brute(rows, list(steps), seconds)


def test_hot_sequence_spreads_over_ranges_and_is_stitched(spark):
    rows = [(n, None if n % 3 == 0 else n % 50, minute((n * 7919) % 5000), "abcdx"[(n * 31 + n // 7) % 5], "own", n) for n in range(6000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for seconds in (3600, 600_000):
            assert got(spark, rows, list("abcd"), seconds) == fast(rows, list("abcd"), seconds)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_start_in_the_first_range_reaches_the_last(spark):
    rows = [(0, 5, minute(0), "a", "own", 0)] + [(n, 5, minute(n), "x", "own", n) for n in range(1, 3000)] + [(3000, 5, minute(3000), "b", "own", 0)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert [r for r in got(spark, rows, ["a", "b"], 3000 * 60) if r[3] == "b"] == [(*rows[-1], 2, START)]
        assert [r for r in got(spark, rows, ["a", "b"], 3000 * 60 - 1) if r[3] == "b"] == [(*rows[-1], None, None)]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_empty_report_and_clashing_names(spark):
    assert got(spark, [], ["a", "b"], 60) == []
    none = spark.createDataFrame([], SCHEMA)
    progress = funnel.funnel_progress(none, ["a", "b"], limit_seconds=60, keys=["customer_id"])
    report = funnel.funnel_report(funnel.funnel_by_key(progress, ["customer_id"], 2), ["a", "b"])
    assert sorted(map(tuple, report.collect())) == [(1, "a", 0, 0), (2, "b", 0, 0)]
    with pytest.raises(ValueError, match="without the columns"):
        funnel.funnel_progress(none.withColumn("Funnel_Step", none.at), ["a"], limit_seconds=60, keys=["customer_id"])


def test_no_window_over_a_whole_sequence(spark):
    df = funnel.funnel_progress(spark.range(10).selectExpr("id event_id", "1L customer_id", "timestamp_ntz'2026-01-01' created_at", "'a' event_type"),
                                ["a", "b"], limit_seconds=60, keys=["customer_id"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    # sequences are scanned by (range, key); only the tables of one row per range and key are ordered by range
    assert all("part#" in line for line in plan.splitlines() if " Window [" in line and "last(" in line)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan

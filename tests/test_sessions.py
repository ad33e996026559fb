"""Sessions against walking each customer's events, with one customer of a third of all events."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from martlet.operators import sessions

SCHEMA = "event_id long, customer_id long, created_at timestamp_ntz, event_type string, own_column string"
START = datetime(2026, 1, 1)


def brute(rows, gap):
    out, seen = [], {}
    for event, customer, at, _ in sorted((r for r in rows if r[2]), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[0] is not None, r[0] or 0)):
        number, last, first = seen.get(customer, (0, None, None))
        if last is None or at > last + timedelta(seconds=gap):
            number, first = number + 1, (at, event)
        seen[customer] = (number, at, first)
        out.append((event, customer, at, number, *first))
    return sorted(out + [(e, c, None, None, None, None) for e, c, at, _ in rows if at is None], key=str)


def got(spark, rows, gap=1800):
    found = sessions.event_sessions(spark.createDataFrame([(*r, "p") for r in rows], SCHEMA).repartition(3), gap_seconds=gap)
    assert found.columns == ["event_id", "customer_id", "created_at", "event_type", "own_column", *sessions.FIGURES]
    return sorted(map(tuple, found.drop("event_type", "own_column").collect()), key=str), found


EVENTS = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 30)), st.one_of(st.none(), st.integers(1, 3)),
                            st.one_of(st.none(), st.integers(0, 40).map(lambda m: START + timedelta(minutes=10 * m))), st.just("home")), max_size=60)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(EVENTS)
def test_random_events(spark, rows):
    assert got(spark, rows)[0] == brute(rows, 1800)


def test_anonymous_events_spread_over_ranges_and_are_stitched(spark):
    rows = [(k, None if k % 3 else k % 50, START + timedelta(seconds=(k * 7919) % 400_000), "purchase" if k % 10 == 0 else "home") for k in range(6000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found, frame = got(spark, rows, 120)
        assert found == brute(rows, 120)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    summary = sessions.session_summary(frame).collect()
    assert sum(r["event_count"] for r in summary) == 6000 and sum(r["purchase_count"] for r in summary) == 600
    assert {(r["customer_id"], r["session_number"], r["session_started_at"]) for r in summary} == {(c, n, a) for _, c, _, n, a, _ in found}


def test_no_events(spark):
    assert got(spark, [])[0] == []

"""As-of join against looking every row's version up, with one key of a third of all rows."""

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from martlet.operators import asof

ROWS = "row_id long, k long, at timestamp_ntz, version string, part int"
VERSIONS = "product long, since timestamp_ntz, until timestamp_ntz, price double, name string"
START = datetime(2026, 1, 1)
minute = lambda m: START + timedelta(minutes=m)


def brute(rows, versions, ends):
    out = []
    for row in rows:
        _, k, at, *_ = row
        known = [] if k is None or at is None else [v for v in versions if v[0] == k and v[1] is not None and v[1] <= at]
        least = lambda x: (x is not None, x if x is not None else 0)
        best = max(known, key=lambda v: (v[1], *([(v[2] is not None, v[2] or START)] if ends else []), least(v[3]), (v[4] is not None, v[4] or "")), default=None)
        if best and ends and best[2] is not None and at >= best[2]:
            best = None
        out.append((*row, *(best[3:] if best else (None, None))))
    return sorted(out, key=str)


def got(spark, rows, versions, ends=True):
    one, two = spark.createDataFrame([tuple(r) for r in rows], ROWS).repartition(3), spark.createDataFrame(versions, VERSIONS).repartition(2)
    found = asof.as_of_join(one, two, key="k", instant="at", version_key="product", valid_from="since", valid_to="until" if ends else None,
                            values={"price": "price", "name": "found"})
    assert found.columns == [*one.columns, "price", "found"]
    return sorted(map(tuple, found.collect()), key=str)


KEY = st.one_of(st.none(), st.integers(1, 3))
AT = st.one_of(st.none(), st.integers(0, 12).map(minute))
SOME_ROWS = st.lists(st.tuples(st.integers(0, 9), KEY, AT, st.just("own"), st.just(7)), max_size=30)
SOME_VERSIONS = st.lists(st.tuples(KEY, AT, AT, st.one_of(st.none(), st.sampled_from([1.5, 2.0])), st.one_of(st.none(), st.sampled_from("ab"))), max_size=15)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(SOME_ROWS, SOME_VERSIONS, st.booleans())
def test_random_rows_and_versions(spark, rows, versions, ends):
    assert got(spark, rows, versions, ends) == brute(rows, versions, ends)


def test_hot_key_spreads_over_ranges_and_is_stitched(spark):
    rows = [(n, None if n % 40 == 3 else 5 if n % 3 == 0 else n % 20, minute((n * 7919) % 5000), "own", n) for n in range(3000)]
    rows += [(n, 5, minute(2500), "own", n) for n in range(3000, 4000)]  # one key and instant
    versions = [(k, minute(m + k), minute(m + k + 700) if k % 2 else None, float(m), f"v{m}") for k in range(20) for m in range(0, 4000, 800)]
    versions += [(5, minute(2405), None, 9.0, "tie"), (5, minute(2500), None, 1.0, "new")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for ends in (True, False):
            assert got(spark, rows, versions, ends) == brute(rows, versions, ends)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_empty_sides_and_clashing_names(spark):
    row = (1, 1, START, "own", 7)
    assert got(spark, [], [(1, START, None, 1.0, "a")]) == [] and got(spark, [row], []) == [(*row, None, None)]
    one, two = spark.createDataFrame([row], ROWS), spark.createDataFrame([], VERSIONS)
    with pytest.raises(ValueError, match="twice"):
        asof.as_of_join(one, two, key="k", instant="at", version_key="product", valid_from="since", values={"price": "VERSION"})

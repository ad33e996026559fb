"""Cube with bitmaps against sets, with one group of a third of all rows."""

from itertools import product

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from martlet.operators import cubes

SCHEMA = "shop string, kind long, customer long, bill long, items long, d0 int, level int"


def brute(rows):
    out = {}
    for shop, kind, customer, bill, items in rows:
        for a, b in product((0, 1), repeat=2):
            cell = out.setdefault((None if a else shop, None if b else kind, 2 * a + b), [0, set(), set(), None])
            cell[0] += 1
            cell[1] |= {customer} - {None}
            cell[2] |= {bill} - {None}
            cell[3] = cell[3] if items is None else (cell[3] or 0) + items
    return sorted(((*k, n, len(c), len(b), s) for k, (n, c, b, s) in out.items()), key=str)


def got(spark, rows):
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA).repartition(3)
    found = cubes.sales_cube(frame, ["shop", "kind"], {"customer": "customers", "bill": "bills"}, {"items": "item_total"})
    assert found.columns == ["shop", "kind", "level", "row_count", "customers", "bills", "item_total"]
    return sorted(map(tuple, found.collect()), key=str), found


IDS = st.one_of(st.none(), st.sampled_from([0, 1, 32767, 32768, 32769, -1, -32768, 2**40]))
ROWS = st.lists(st.tuples(st.one_of(st.none(), st.sampled_from("ab")), st.one_of(st.none(), st.integers(0, 1)), IDS, IDS, st.one_of(st.none(), st.integers(-3, 9))), max_size=30)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(ROWS)
def test_random_rows(spark, rows):
    assert got(spark, rows)[0] == brute(rows)


def test_hot_group_and_one_reading_per_base(spark):
    rows = [("hot" if n % 3 else f"s{n % 40}", n % 7 if n % 5 else None, (n * 7919) % 70_000, n // 4, n % 9) for n in range(6000)]
    found, frame = got(spark, rows)
    assert found == brute(rows)
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") == 2 and plan.count("bitmap_construct_agg") == 1 and "distinct" not in plan.lower()


def test_no_rows(spark):
    assert got(spark, [])[0] == []

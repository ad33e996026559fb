"""Day axis and running totals against walking each key's days."""

from collections import defaultdict
from datetime import date, timedelta
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from martlet.operators import spine

SCHEMA = "shop string, day date, items long, amount decimal(18,4), first_day long, of_shop string"
START = date(2026, 1, 20)


def brute(rows, period):
    cells, seen = defaultdict(lambda: [0, 0, Decimal(0)]), defaultdict(set)
    for shop, day, items, amount in rows:
        cell = cells[shop, day]
        cell[0], cell[1], cell[2] = cell[0] + 1, cell[1] + (items or 0), cell[2] + (amount or 0)
        seen[shop].add(day)
    out = []
    for shop, days in seen.items():
        if None in days:
            out.append((shop, None, *cells[shop, None][:2], *[None] * 4, cells[shop, None][2], *[None] * 4))
        days = days - {None}
        if not days:
            continue
        first, running, mtd, before = min(days), [0, Decimal(0)], [0, Decimal(0)], None
        for n in range((max(days) - first).days + 1):
            day = first + timedelta(n)
            count, *now = cells.get((shop, day), [0, 0, Decimal(0)])
            mtd = [0, Decimal(0)] if before != (day.year, day.month) else mtd
            before = (day.year, day.month)
            running, mtd = [a + b for a, b in zip(running, now)], [a + b for a, b in zip(mtd, now)]
            earlier = cells.get((shop, day - timedelta(period)), [0, 0, Decimal(0)])[1:] if n >= period else [None, None]
            row = [shop, day, count]
            for i in range(2):
                row += [now[i], running[i], mtd[i], earlier[i], None if earlier[i] is None else now[i] - earlier[i]]
            out.append(tuple(row))
    return sorted(out, key=str)


def got(spark, rows, period=7):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)
    found = spine.running_totals(frame, ["shop"], "day", ["items", "amount"], period)
    assert len(found.columns) == len(set(found.columns)) == 13
    return sorted(map(tuple, found.collect()), key=str), found


def canonical(rows):
    """Decimals by value: 0 and 0.0000 are one figure."""
    return sorted((tuple(v.normalize() + 0 if isinstance(v, Decimal) else v for v in r) for r in rows), key=str)


ROWS = st.lists(st.tuples(st.one_of(st.none(), st.sampled_from("ab")), st.one_of(st.none(), st.integers(0, 75).map(lambda n: START + timedelta(n))),
                          st.one_of(st.none(), st.integers(-5, 9)), st.one_of(st.none(), st.integers(-999, 999).map(lambda n: Decimal(n) / 100))), max_size=30)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(ROWS, st.sampled_from([1, 7, 40]))
def test_random_rows(spark, rows, period):
    assert canonical(got(spark, rows, period)[0]) == canonical(brute(rows, period))


def test_one_key_of_a_third_of_all_rows_over_years(spark):
    rows = [("hot" if k % 3 == 0 else None if k % 50 == 1 else f"s{k % 5}", START + timedelta((k * 7919) % 900 if k % 4 else (k * 31) % 37),
             k % 11, Decimal(k % 101) / 4) for k in range(4000)]
    assert canonical(got(spark, rows)[0]) == canonical(brute(rows, 7))


def test_windows_hold_a_month_of_days_or_the_months_of_a_key(spark):
    _, found = got(spark, [("a", START, 1, Decimal(1)), ("a", START + timedelta(60), 2, None)])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "windowspecdefinition" in line]
    assert len(windows) == 2 and sum("in_month" in w.split("windowspecdefinition(")[1].split(" ASC")[0] for w in windows) == 2
    assert "Cartesian" not in found._jdf.queryExecution().executedPlan().toString()


def test_no_rows_and_refusals(spark):
    assert got(spark, [])[0] == []
    for keys, period in (([], 7), (["shop"], 0)):
        with pytest.raises(ValueError):
            spine.running_totals(spark.createDataFrame([], SCHEMA), keys, "day", ["items"], period)

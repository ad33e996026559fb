"""Top k per group against sorting every group, with one group of a third of all rows; the limit is placed before the exchange."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from martlet.operators import topk

SCHEMA = "g string, score double, id long, own string, place int, slice int"


def brute(rows, k, ties):
    out = []
    for g in {r[0] for r in rows}:
        group = [r for r in rows if r[0] == g]
        beats = (lambda a, b: key(a)[:1] < key(b)[:1]) if ties else (lambda a, b: key(a) < key(b))
        key = lambda r: ((r[1] is None, -(r[1] or 0)), (r[2] is None, r[2] or 0))
        for r in group:
            place = 1 + sum(beats(o, r) for o in group)
            if place <= k:
                out.append((*r, place))
    return sorted(out, key=str)


def got(spark, rows, k, ties):
    df = spark.createDataFrame([tuple(r) for r in rows], SCHEMA).repartition(5)
    best = {"score": True} if ties else {"score": True, "id": False}
    return sorted(map(tuple, topk.top_k(df, ["g"], best, k, ties=ties).collect()), key=str)


ROWS = st.lists(st.tuples(st.one_of(st.none(), st.sampled_from("ab")), st.one_of(st.none(), st.integers(0, 4).map(float)), st.one_of(st.none(), st.integers(0, 99)), st.just("o"),
                          st.just(1), st.just(2)), max_size=30, unique_by=lambda r: (r[0], r[2]))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(ROWS, st.integers(1, 4), st.booleans())
def test_random_groups(spark, rows, k, ties):
    assert got(spark, rows, k, ties) == brute(rows, k, ties)


def test_repeated_rows_take_places_of_their_own(spark):
    rows = [("a", 1.0, 1, "o", 1, 2)] * 5
    assert [r[-1] for r in got(spark, rows, 3, False)] == [1, 2, 3]
    assert [r[-1] for r in got(spark, rows, 3, True)] == [1] * 5


def test_bad_arguments_and_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert topk.top_k(df, ["g"], {"id": True}, 2).collect() == []
    for wrong in (dict(k=0), dict(k=1, rank="Score")):
        with pytest.raises(ValueError):
            topk.top_k(df, ["g"], {"id": True}, **wrong)


def test_hot_group_is_limited_before_it_is_shuffled(spark, tmp_path):
    spark.range(0, 200_000, 1, 40).selectExpr("if(id % 3 = 0, 'hot', concat('g', id % 1000)) g", "(id * 7919) % 200000 score", "id").write.parquet(f"{tmp_path}/rows")
    df = topk.top_k(spark.read.parquet(f"{tmp_path}/rows"), ["g"], {"score": True, "id": False}, 3)
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = [line for line in plan.splitlines() if "WindowGroupLimit" in line or "Exchange" in line]
    kinds = ["exchange" if "Exchange" in line else "partial" if "Partial" in line else "final" for line in lines]
    assert kinds == ["final", "exchange", "partial", "final", "exchange", "partial"]
    hot = df.filter("g = 'hot'").orderBy("rank").collect()
    assert [r.score for r in hot] == sorted(((i * 7919) % 200000 for i in range(0, 200_000, 3)), reverse=True)[:3]

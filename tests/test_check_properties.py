"""Fused checks equal the per-column checks and a brute-force Python model."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from martlet.operators import checks

small_int = st.one_of(st.none(), st.integers(min_value=0, max_value=6))
rows = st.lists(st.tuples(small_int, small_int, st.sampled_from(["a", "b", "c", None])), min_size=0, max_size=25)
parents = st.lists(st.one_of(st.none(), st.integers(min_value=0, max_value=6)), min_size=0, max_size=8)
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _child(spark, data):
    return spark.createDataFrame(data, "x long, y long, s string")


@SETTINGS
@given(data=rows)
def test_unique_fused_matches_brute_force(spark, data):
    df = _child(spark, data)
    got = {(r.column_name, r.value, r.n_records) for r in checks.unique_fused("m", df, ["x", "y"]).collect()}
    want = set()
    for i, col in enumerate(["x", "y"]):
        for v, n in Counter(r[i] for r in data if r[i] is not None).items():
            if n > 1:
                want.add((col, str(v), n))
    assert got == want


@SETTINGS
@given(data=rows, px=parents, py=parents)
def test_relationships_fused_matches_single_and_brute_force(spark, data, px, py):
    df = _child(spark, data)
    p1 = spark.createDataFrame([(v,) for v in px], "k long")
    p2 = spark.createDataFrame([(v,) for v in py], "k long")
    fused = checks.relationships_fused("m", df, {"x": ("p1", p1, "k"), "y": ("p2", p2, "k")})
    got = {(r.column_name, r.parent_model, r.value, r.n_records) for r in fused.collect()}
    single = checks.union_all([checks.relationships("m", df, "x", "p1", p1, "k"),
                               checks.relationships("m", df, "y", "p2", p2, "k")])
    assert got == {(r.column_name, r.parent_model, r.value, r.n_records) for r in single.collect()}
    want = set()
    for i, (col, pm, keys) in enumerate([("x", "p1", set(px)), ("y", "p2", set(py))]):
        for v, n in Counter(r[i] for r in data if r[i] is not None and r[i] not in keys).items():
            want.add((col, pm, str(v), n))
    assert got == want


@SETTINGS
@given(data=rows)
def test_accepted_values_fused_mixed_types(spark, data):
    df = _child(spark, data)
    got = {(r.column_name, r.value, r.n_records)
           for r in checks.accepted_values_fused("m", df, {"x": (1, 2), "s": ("a", "b")}).collect()}
    want = set()
    for v, n in Counter(r[0] for r in data if r[0] is not None and r[0] not in (1, 2)).items():
        want.add(("x", str(v), n))
    for v, n in Counter(r[2] for r in data if r[2] is not None and r[2] not in ("a", "b")).items():
        want.add(("s", v, n))
    assert got == want


@SETTINGS
@given(data=rows)
def test_not_null_matches_brute_force(spark, data):
    df = _child(spark, data)
    got = {r.column_name: r.failures for r in checks.not_null("m", df, ["x", "y", "s"]).collect()}
    assert got == {c: sum(1 for r in data if r[i] is None) for i, c in enumerate(["x", "y", "s"])}

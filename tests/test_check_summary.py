"""The one-grouping summary against counting every declared test by itself, and its plan."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from martlet.catalog import REGISTRY
from martlet.operators import checks

from conftest import SMALL

BATCH, OTHER = "20260101T000000Z", "20260201T000000Z"
DECLARED = {
    "parent": {"not_null": ["id", "code"], "unique": ["id", "code"], "row_count_source": "parents"},
    "child": {"not_null": ["a", "b", "t"], "unique": ["a"], "relationships": {"a": ("parent", "id"), "b": ("parent", "id"), "t": ("parent", "code")},
              "accepted_values": {"t": ("x", "y"), "b": (1, 2)}, "row_count_source": "children"},
    "grandchild": {"relationships": {"n": ("parent", "code")}, "not_null": ["n"]},
    "elsewhere": {"unique": ["id"]},
}
INT = st.one_of(st.none(), st.integers(0, 4))
TEXT = st.one_of(st.none(), st.sampled_from(["x", "y", "z", "1"]))
COUNTS = st.one_of(st.none(), st.integers(0, 3))


def brute(parent, child, grand, raw_parents, raw_children):
    known = lambda rows, i: {r[i] for r in rows}
    doubled = lambda rows, i: sum(n > 1 for v, n in Counter(r[i] for r in rows if r[i] is not None).items())
    orphans = lambda rows, i, keys: sum(1 for r in rows if r[i] is not None and r[i] not in keys)
    out = {("unique", "parent", "id"): doubled(parent, 0), ("unique", "parent", "code"): doubled(parent, 1), ("unique", "child", "a"): doubled(child, 0),
           ("relationships", "child", "a"): orphans(child, 0, known(parent, 0)), ("relationships", "child", "b"): orphans(child, 1, known(parent, 0)),
           ("relationships", "child", "t"): orphans(child, 2, known(parent, 1)),
           ("relationships", "grandchild", "n"): sum(1 for r in grand if r[0] is not None and str(r[0]) not in known(parent, 1)),
           ("accepted_values", "child", "t"): len(known(child, 2) - {None, "x", "y"}), ("accepted_values", "child", "b"): len(known(child, 1) - {None, 1, 2}),
           ("batch_row_count_matches", "parent", None): int(raw_parents != len(parent) or not raw_parents),
           ("batch_row_count_matches", "child", None): int(raw_children != len(child) or not raw_children)}
    for model, rows, columns in (("parent", parent, ("id", "code")), ("child", child, ("a", "b", "t")), ("grandchild", grand, ("n",))):
        out.update({("not_null", model, c): sum(r[i] is None for r in rows) for i, c in enumerate(columns)})
    return out


def got(spark, parent, child, grand, raw_parents, raw_children):
    models = {"parent": spark.createDataFrame(parent, "id long, code string"), "child": spark.createDataFrame(child, "a int, b long, t string"),
              "grandchild": spark.createDataFrame(grand, "n int")}
    raw = {t: spark.createDataFrame([(BATCH,)] * n + [(OTHER,)], "_BATCH_ID string") for t, n in (("parents", raw_parents), ("children", raw_children))}
    rows = checks.check_summary(models, raw, BATCH, DECLARED).collect()
    found = {(r.test_name, r.model, r.column_name): r.failures for r in rows}
    assert len(found) == len(rows)
    return found


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(INT, TEXT), max_size=8), st.lists(st.tuples(INT, INT, TEXT), max_size=15), st.lists(st.tuples(COUNTS), max_size=6), st.integers(0, 4), st.integers(0, 9))
def test_random_models(spark, parent, child, grand, raw_parents, raw_children):
    args = (parent, child, grand, raw_parents, raw_children)
    assert got(spark, *args) == brute(*args)


def test_matching_counts_pass_and_empty_models_fail_only_their_count(spark):
    parent, child = [(1, "x")], [(1, 1, "x"), (1, 2, "y")]
    found = got(spark, parent, child, [], 1, 2)
    assert found["batch_row_count_matches", "parent", None] == found["batch_row_count_matches", "child", None] == 0
    nothing = got(spark, [], [], [], 0, 0)
    assert {k for k, n in nothing.items() if n} == {("batch_row_count_matches", "parent", None), ("batch_row_count_matches", "child", None)}


def test_more_columns_than_one_mask_holds(spark):
    columns = [f"c{i}" for i in range(130)]
    df = spark.range(4).selectExpr(*[f"if(id % {2 + i % 3} = 0, null, id) {c}" for i, c in enumerate(columns)])
    rows = checks.check_summary({"wide": df}, {}, BATCH, {"wide": {"not_null": columns}}).collect()
    assert {r.column_name: r.failures for r in rows} == {c: (2, 2, 1)[i % 3] for i, c in enumerate(columns)}


def test_dates_are_keys_and_doubles_are_refused(spark):
    days = spark.sql("SELECT explode(array(DATE'2026-01-01', DATE'2026-01-01', DATE'2026-01-02', null)) d, 1.5D x")
    assert checks.check_summary({"m": days}, {}, BATCH, {"m": {"unique": ["d"]}}).first().failures == 1
    with pytest.raises(ValueError, match="keys of type double"):
        checks.check_summary({"m": days}, {}, BATCH, {"m": {"unique": ["x"]}})


def test_one_scan_per_model_and_counted_table(spark):
    plan = REGISTRY["check_summary"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") <= 18  # eleven models, seven RAW tables
    assert plan.count("Exchange hashpartitioning") <= 4 and "LeftAnti" not in plan


def test_hot_reference_is_combined_before_the_exchange(spark):
    parent = spark.range(1, 10).selectExpr("id", "string(id) code")
    child = spark.range(0, 100_000, 1, 8).selectExpr("if(id % 3 = 0, 77, id % 9 + 1) a", "1L b", "'x' t")
    raw = {t: spark.createDataFrame([(BATCH,)], "_BATCH_ID string") for t in ("parents", "children")}
    rows = checks.check_summary({"parent": parent, "child": child}, raw, BATCH, {"parent": {"unique": ["id"]}, "child": {"relationships": {"a": ("parent", "id")}}}).collect()
    assert {(r.test_name, r.failures) for r in rows} == {("unique", 0), ("relationships", 33_334)}

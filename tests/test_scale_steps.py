"""Steps that many queries share: what they write and shuffle grows with their rows alone."""

import os
import tempfile

from martlet.plans.batch_build import build
from martlet.sources import driver_tables
from martlet.sources.raw_store import LandedOnUse

FIRST, SECOND = driver_tables.SELECTED_BATCH, driver_tables.SECOND_BATCH


def test_raw_table_computes_its_extract_once(spark, monkeypatch):
    rows = spark.createDataFrame([(0, "a"), (1, "b"), (1, "b"), (2, None), (None, "n")], "id long, name string")
    monkeypatch.setitem(driver_tables.EXTRACTORS, "users", lambda *_: rows.repartition(3))
    raw = driver_tables.raw_table(spark, "", "users")
    got = sorted((str(r.ID), str(r.NAME), r._BATCH_ID, r._EXTRACTED_AT.isoformat()) for r in raw.collect())
    stamps = {b: f"2001-0{m}-01T00:00:00" for b, m in ((FIRST, 6), (SECOND, 7))}
    keys = [("0", "a", FIRST), ("1", "b", FIRST), ("1", "b", FIRST), ("2", "None", FIRST), ("None", "n", FIRST),
            ("1", "b", SECOND), ("1", "b", SECOND), ("2", "None", SECOND)]
    assert [g[:3] for g in got] == sorted(keys) and {g[2]: g[3] for g in got} == stamps
    assert raw.columns == ["ID", "NAME", "_BATCH_ID", "_EXTRACTED_AT"]
    plan = raw._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") + plan.count("Repartition 3") == 1 and "Union" not in plan


def test_raw_tables_are_landed_on_first_use(spark):
    root = tempfile.mkdtemp(prefix="martlet-lazy-")
    table = spark.createDataFrame([(1, FIRST), (2, SECOND)], "ID long, _BATCH_ID string")
    raw = LandedOnUse(spark, {"b": table, "a": table}, root)
    assert sorted(raw) == ["a", "b"] and os.listdir(root) == []
    assert raw["a"].count() == 2 and os.listdir(root) == ["a"]
    assert raw["a"] is raw["a"]
    assert [t for t, _ in raw.items()] == ["a", "b"] and sorted(os.listdir(root)) == ["a", "b"]


def test_mart_is_made_on_first_use():
    made = []
    b = build({}, FIRST).with_tables("fact", lambda: made.append(1) or "mart")
    assert b.fct_order_items == "fact" and made == []
    assert b.mart_daily_sales == "mart" and b.mart_daily_sales == "mart" and made == [1]


def test_raw_is_written_without_a_sort(spark):
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) > 0

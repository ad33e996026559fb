import os
import tempfile
from datetime import datetime, timedelta, timezone

import pytest

from martlet.config import TABLES
from martlet.sources import landing
from martlet.sources.raw_store import land_raw


def test_stamp_batch_upper_cases_and_adds_lineage(spark):
    df = spark.createDataFrame([(1, "a")], "id long, Name string")
    out = landing.stamp_batch(df, "20260101T000000Z", datetime(2026, 1, 1, 12, tzinfo=timezone.utc))
    assert out.columns == ["ID", "NAME", "_BATCH_ID", "_EXTRACTED_AT"]
    r = out.first()
    assert r["_BATCH_ID"] == "20260101T000000Z"
    with pytest.raises(ValueError):
        landing.stamp_batch(df, "2026-01-01", datetime(2026, 1, 1, tzinfo=timezone.utc))


def test_write_guard_rejects_empty_and_torn(spark):
    root = tempfile.mkdtemp(prefix="martlet-test-")
    df = spark.createDataFrame([(i,) for i in range(5)], "x int")
    assert landing.write_batch_table(df, f"{root}/ok", 5) == 5
    with pytest.raises(RuntimeError):
        landing.write_batch_table(df, f"{root}/torn", 6)
    assert sorted(os.listdir(root)) == ["ok"]                              # nothing readable is left
    assert landing.write_batch_table(df, f"{root}/torn", 5) == 5           # and the retry works
    with pytest.raises(RuntimeError):
        landing.write_batch_table(df.limit(0), f"{root}/empty")


def test_align_to_table_by_name_case_insensitive(spark):
    table = spark.createDataFrame([], "ID long, STATUS string, CREATED_AT timestamp").schema
    arriving = spark.createDataFrame([("x", 3, "extra")], "status string, id int, unknown string")
    out = landing.align_to_table(arriving, table)
    assert out.columns == ["ID", "STATUS", "CREATED_AT"]
    assert tuple(out.first()) == (3, "x", None)


def test_raw_store_prunes_partitions(spark):
    root = tempfile.mkdtemp(prefix="martlet-raw-")
    df = spark.createDataFrame([(1,), (2,)], "id long")
    two = landing.stamp_batch(df, "20260101T000000Z", "2026-01-01 00:00:00").unionByName(
        landing.stamp_batch(df.limit(1), "20260201T000000Z", "2026-02-01 00:00:00"))
    stored = land_raw(spark, {"t": two}, root)["t"]
    assert stored.columns == two.columns
    sel = stored.filter("_BATCH_ID = '20260201T000000Z'")
    plan = sel._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and sel.count() == 1
    assert [d for d in sorted(os.listdir(f"{root}/t")) if d.startswith("_BATCH_ID=")] == [
        "_BATCH_ID=20260101T000000Z", "_BATCH_ID=20260201T000000Z"]


def test_manifest_completeness_and_latest(spark):
    m = spark.createDataFrame(
        [(t, "20260101T000000Z", 5) for t in TABLES]
        + [("orders", "20260201T000000Z", 3), ("junk", "20260201T000000Z", 1), ("orders", "20261231", 9)],
        "table_name string, batch_id string, row_count long")
    status = {r.batch_id: r for r in landing.complete_batches(m).collect()}
    assert status["20260101T000000Z"].is_complete and not status["20260201T000000Z"].is_complete
    assert status["20260201T000000Z"].unknown_tables == 1 and status["20260201T000000Z"].missing_tables == 6
    latest = landing.latest_batch(m).first()
    assert latest.batch_id == "20260201T000000Z" and latest.is_complete is False


def test_assert_loadable_refuses_incomplete_unknown_and_missing(spark):
    m = spark.createDataFrame(
        [(t, "20260101T000000Z", 5) for t in TABLES]
        + [("orders", "20260201T000000Z", 3)],
        "table_name string, batch_id string, row_count long")
    status = landing.complete_batches(m)
    landing.assert_loadable(status, "20260101T000000Z")
    for bad in ("20260201T000000Z", "20260301T000000Z"):
        with pytest.raises(ValueError):
            landing.assert_loadable(status, bad)
    with pytest.raises(ValueError):
        landing.assert_loadable(status, "20260101T000000Z\n")


def test_append_new_batches_is_idempotent_and_aligns_by_name(spark):
    root = tempfile.mkdtemp(prefix="martlet-append-")
    first = landing.stamp_batch(spark.createDataFrame([(1, "a"), (2, "b")], "id long, status string"),
                                "20260101T000000Z", "2026-01-01 00:00:00")
    assert landing.append_new_batches(spark, first, root, "t") == 2
    assert landing.append_new_batches(spark, first, root, "t") == 0          # already loaded
    later = landing.stamp_batch(spark.createDataFrame([("c", 3, "x")], "Status string, ID int, extra string"),
                                "20260201T000000Z", "2026-02-01 00:00:00")
    assert landing.append_new_batches(spark, later, root, "t") == 1
    got = spark.read.parquet(f"{root}/t")
    assert sorted(got.columns) == ["ID", "STATUS", "_BATCH_ID", "_EXTRACTED_AT"]
    assert sorted((r.ID, r.STATUS) for r in got.collect()) == [(1, "a"), (2, "b"), (3, "c")]


def test_stamped_instant_ignores_the_session_time_zone(spark):
    from martlet.session import configure
    df = spark.createDataFrame([(1,)], "id long")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        a = landing.stamp_batch(df, "20260101T000000Z", "2001-06-01 00:00:00")
        b = landing.stamp_batch(df, "20260101T000000Z", datetime(2001, 6, 1, 9, tzinfo=timezone(timedelta(hours=9))))
        got = [r[0] for r in a.unionByName(b).selectExpr("unix_micros(_EXTRACTED_AT)").collect()]
    finally:
        configure(spark)
    assert got == [991353600000000, 991353600000000]       # 2001-06-01T00:00:00Z


def test_latest_batch_ignores_malformed_ids_that_sort_higher(spark):
    m = spark.createDataFrame(
        [("orders", "20260101T000000Z", 5), ("orders", "20261231T000000Z\n", 5), ("orders", "20261231T000000Zx", 1),
         ("orders", "20260301T120000Z", 2)],
        "table_name string, batch_id string, row_count long")
    assert landing.latest_batch(m).first().batch_id == "20260301T120000Z"


def test_delivered_batch_needs_its_marker(spark):
    root = tempfile.mkdtemp(prefix="martlet-deliver-")
    extracts = {t: spark.createDataFrame([(i, t) for i in range(3)], "id long, name string") for t in TABLES}
    instant = datetime(2026, 3, 1, 9, tzinfo=timezone(timedelta(hours=9)))
    with pytest.raises(RuntimeError):                                      # a torn table leaves no marker
        landing.deliver_batch(spark, extracts, f"{root}/a", instant, {t: 4 if t == "users" else 3 for t in TABLES})
    with pytest.raises(ValueError, match="marker"):
        landing.load_delivered(spark, f"{root}/a", "20260301T000000Z", f"{root}/raw")
    assert landing.deliver_batch(spark, extracts, f"{root}/b", instant) == "20260301T000000Z"
    assert landing.load_delivered(spark, f"{root}/b", "20260301T000000Z", f"{root}/raw") == {t: 3 for t in TABLES}
    assert landing.load_delivered(spark, f"{root}/b", "20260301T000000Z", f"{root}/raw") == {t: 0 for t in TABLES}
    with pytest.raises(ValueError):
        landing.deliver_batch(spark, {"users": extracts["users"]}, f"{root}/c", instant)


def test_further_rows_of_a_batch_come_under_another_source(spark):
    root = tempfile.mkdtemp(prefix="martlet-more-")
    part = lambda a, b: landing.stamp_batch(spark.range(a, b).withColumnRenamed("id", "Id"), "20260101T000000Z", "2026-01-01 00:00:00")
    assert landing.append_new_batches(spark, part(0, 5), root, "t", "file-1") == 5
    assert landing.append_new_batches(spark, part(5, 9), root, "t", "file-2") == 4
    assert landing.append_new_batches(spark, part(5, 9), root, "t", "file-2") == 0
    assert sorted(r.ID for r in spark.read.parquet(f"{root}/t").collect()) == list(range(9))

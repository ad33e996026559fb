import datetime as dt
import tempfile
from decimal import Decimal

import pytest

from martlet.operators import export

SCHEMA = "order_date date, source_batch_id string, order_count bigint, item_count bigint, amount decimal(28,4)"


def _mart(spark, batches=("20260101T000000Z",)):
    rows = [(dt.date(2020, 1, d), b, d, 2 * d, Decimal("1.2500")) for b in batches for d in (3, 1, 2)]
    return spark.createDataFrame(rows, SCHEMA)


def test_export_guards_refuse_empty_and_mixed_batches(spark):
    with pytest.raises(RuntimeError, match="empty"):
        export.export_mart(_mart(spark).limit(0), tempfile.mkdtemp(prefix="martlet-exp-") + "/a")
    with pytest.raises(RuntimeError, match="single batch"):
        export.export_mart(_mart(spark, ("20260101T000000Z", "20260201T000000Z")),
                           tempfile.mkdtemp(prefix="martlet-exp-") + "/b")


def test_export_is_ordered_verified_and_fingerprinted(spark):
    mart = _mart(spark)
    paths = export.export_mart(mart, tempfile.mkdtemp(prefix="martlet-exp-") + "/c")
    assert paths["rows"] == 3
    copy = spark.read.parquet(paths["parquet"])
    assert [r.order_date.day for r in copy.collect()] == [1, 2, 3]          # ordered by date
    v = export.verify_export(spark, mart, paths).first()
    assert v.matches_table and (v.json_rows, v.json_item_count, v.json_order_count) == (3, 12, 6)
    fp = {r.copy: (r.row_count, r.fingerprint) for r in export.fingerprint_export(spark, mart, paths).collect()}
    assert fp["table"] == fp["parquet"] == fp["json"]


def test_record_is_written_and_a_mismatch_stops(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="martlet-exp-")
    done = export.export_and_record(spark, _mart(spark), f"{root}/good")
    record = {r["copy"]: (r["row_count"], r["fingerprint"]) for r in spark.read.json(done["record"]).collect()}
    assert len(record) == 3 and len(set(record.values())) == 1
    real = export.export_mart
    monkeypatch.setattr(export, "export_mart", lambda mart, out: real(mart.withColumn("order_count", mart.order_count + 1), out))
    with pytest.raises(RuntimeError, match="differ"):
        export.export_and_record(spark, _mart(spark), f"{root}/bad")

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martlet.functions import (MONEY, any_distinct, batch_id_from_ts, distinct_from, iff_money,
                               is_valid_batch_id, money, require_batch_id, table_fingerprint, utc_ntz)


def test_require_batch_id_whole_string():
    assert require_batch_id("20261005T161059Z") == "20261005T161059Z"
    for bad in ["20261005", "20261005T161059Z\n", "", " 20261005T161059Z", "20261005T161059"]:
        with pytest.raises(ValueError):
            require_batch_id(bad)


def test_valid_batch_id_column_rejects_trailing_newline(spark):
    df = spark.createDataFrame([("20260101T000000Z",), ("20260101T000000Z\n",), ("20260101",), (None,)], "b string")
    got = [r[0] for r in df.select(is_valid_batch_id("b")).collect()]
    assert got == [True, False, False, None]


def test_batch_id_from_ts_truncates_to_second(spark):
    df = spark.createDataFrame([("2026-10-05 16:10:59.987654",)], "t string").select(F.to_timestamp("t").alias("t"))
    assert df.select(batch_id_from_ts("t")).first()[0] == "20261005T161059Z"


def test_money_rounds_half_up(spark):
    df = spark.createDataFrame([(Decimal("1.00005"),), (Decimal("-0.00005"),), (Decimal("2.00004"),)],
                               "x decimal(10,5)")
    got = [r[0] for r in df.select(money("x")).collect()]
    assert got == [Decimal("1.0001"), Decimal("-0.0001"), Decimal("2.0000")]


def test_iff_money_null_condition_takes_else(spark):
    df = spark.createDataFrame([(None, Decimal("5.0000")), (True, None), (True, Decimal("1.5")), (False, Decimal("9"))],
                               "c boolean, v decimal(18,4)")
    out = df.select(iff_money(F.col("c"), F.col("v")).alias("r"))
    assert out.schema["r"].dataType == MONEY
    assert [r[0] for r in out.collect()] == [Decimal("0.0000"), None, Decimal("1.5000"), Decimal("0.0000")]


def test_distinct_from_is_null_safe(spark):
    df = spark.createDataFrame([(1, 1), (1, None), (None, None), (1, 2)], "a int, b int")
    got = [r[0] for r in df.select(distinct_from(F.col("a"), F.col("b"))).collect()]
    assert got == [False, True, False, True]
    anyd = df.select(any_distinct([(F.col("a"), F.col("b"))], extra=[F.col("a").isNull()])).collect()
    assert [r[0] for r in anyd] == [False, True, True, True]


def test_utc_ntz_is_wall_clock_in_utc(spark):
    # 05:30Z and 06:30Z on a DST change day stay distinct.
    df = spark.createDataFrame([("2020-11-01T05:30:00Z",), ("2020-11-01T06:30:00Z",)], "t string")
    got = [str(r[0]) for r in df.select(utc_ntz(F.to_timestamp("t"))).collect()]
    assert got == ["2020-11-01 05:30:00", "2020-11-01 06:30:00"]


def test_fingerprint_is_order_and_partition_insensitive(spark):
    df = spark.createDataFrame([(i, f"v{i}", None if i % 3 else i * 1.5) for i in range(50)], "a int, b string, c double")
    one = table_fingerprint(df).first()
    two = table_fingerprint(df.repartition(7).orderBy(F.desc("a"))).first()
    assert one == two and one["row_count"] == 50
    changed = table_fingerprint(df.withColumn("b", F.when(F.col("a") == 3, "x").otherwise(F.col("b")))).first()
    assert changed["fingerprint"] != one["fingerprint"]


def test_staging_refuses_a_non_utc_session(spark):
    from martlet.plans.staging import select_batch
    from martlet.session import configure
    raw = spark.createDataFrame([("20260101T000000Z",)], "_BATCH_ID string")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(RuntimeError, match="UTC"):
            select_batch(raw, "20260101T000000Z")
    finally:
        configure(spark)                       # re-pins UTC (and the other settings)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert select_batch(raw, "20260101T000000Z").count() == 1


def test_fingerprint_tells_separators_and_null_texts_apart(spark):
    schema = "a string, b string"
    one = table_fingerprint(spark.createDataFrame([("a|b", "c"), ("\\N", "z")], schema)).first()
    two = table_fingerprint(spark.createDataFrame([("a", "b|c"), (None, "z")], schema)).first()
    assert one["row_count"] == two["row_count"] and one["fingerprint"] != two["fingerprint"]


def test_shared_folder_is_required_on_a_cluster(spark, monkeypatch):
    from martlet import session

    monkeypatch.setattr(session, "is_local", lambda s: False)

    class NoFolder:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: None)})
        sparkContext = type("Context", (), {"getCheckpointDir": staticmethod(lambda: None)})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(NoFolder())

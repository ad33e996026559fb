"""Stored sketches: merging in any order keeps the bounds, on a hot group, small groups (exact), and groups without values."""

import random

from martlet.operators import sketches

SCHEMA = "day int, month int, customer long, amount double"


def write(spark, tmp_path, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    sketches.daily_sketches(df, ["day", "month"], ["customer"], ["amount"]).write.parquet(f"{tmp_path}/days")
    return df, spark.read.parquet(f"{tmp_path}/days")


def test_hot_month_keeps_its_bounds(spark, tmp_path):
    rng = random.Random(5)
    rows = [(n % 28, 1 if n % 3 == 0 else n % 12, n % 9000, float(rng.paretovariate(1.2))) for n in range(60_000)]
    df, days = write(spark, tmp_path, rows)
    months = sketches.merged(days, ["month"], ["customer"], ["amount"])
    found = sketches.measured(df, sketches.estimates(months, ["month"], ["customer"], ["amount"]), "month", "customer", "amount").collect()
    assert {r.month for r in found} == {m for _, m, _, _ in rows} and sum(r.row_count for r in found) == 60_000
    for r in found:
        assert r.distinct_count == len({c for _, m, c, _ in rows if m == r.month})
        assert r.distinct_in_bound and r.amount_p50_in_bound and r.amount_p95_in_bound


def test_merging_in_two_steps_keeps_the_bound(spark, tmp_path):
    rows = [(n % 28, n % 12, n * 17 % 4001, float(n)) for n in range(20_000)]
    _, days = write(spark, tmp_path, rows)
    once = sketches.estimates(sketches.merged(days.selectExpr("*", "1 all"), ["all"], ["customer"], ["amount"]), ["all"], ["customer"], []).first()
    steps = sketches.merged(days, ["month"], ["customer"], ["amount"]).selectExpr("*", "1 all")
    twice = sketches.estimates(sketches.merged(steps, ["all"], ["customer"], ["amount"]), ["all"], ["customer"], []).first()
    for found in (once, twice):
        assert found.row_count == 20_000 and abs(found.customer_distinct - 4001) <= 4001 * sketches.DISTINCT_BOUND


def test_nulls_small_groups_and_no_rows(spark, tmp_path):
    rows = [(None, None, None, None), (None, None, 4, None), (1, 1, 5, 2.0), (1, 1, 5, 2.0), (1, 1, None, 8.0)]
    _, days = write(spark, tmp_path, rows)
    found = {r.day: tuple(r) for r in sketches.estimates(days, ["day"], ["customer"], ["amount"]).collect()}
    assert found == {None: (None, 2, 1, None, None), 1: (1, 3, 1, 2.0, 8.0)}
    empty = sketches.daily_sketches(spark.createDataFrame([], SCHEMA), ["day"], ["customer"], ["amount"])
    assert sketches.estimates(sketches.merged(empty, ["day"], ["customer"], ["amount"]), ["day"], ["customer"], ["amount"]).collect() == []


def test_sketch_size_does_not_follow_the_rows(spark):
    size = lambda n: (sketches.daily_sketches(spark.range(n).selectExpr("1 day", "id customer", "double(id) amount"), ["day"], ["customer"], ["amount"])
                      .selectExpr("length(customer_hll) + length(amount_kll)").first()[0])
    assert size(1_000_000) < 1.5 * size(50_000) < 20_000

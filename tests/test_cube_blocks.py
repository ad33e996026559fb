"""The cube makes every bitmap once, however many tasks read the rows."""

from pyspark.sql import functions as F

from martlet.operators.cubes import sales_cube


def test_bitmaps_are_not_made_once_per_task(spark):
    rows = spark.range(0, 2000, 1, 16).select((F.col("id") % 3).cast("string").alias("status"), (F.col("id") * 7919 % 700).alias("who"), F.lit(1).alias("n"))
    cube = sales_cube(rows, ["status"], {"who": "whos"}, {"n": "total"})
    assert {(r.status, r.whos) for r in cube.collect()} == _counts(rows)
    plan = cube._jdf.queryExecution().executedPlan().toString().splitlines()
    final = next(i for i, line in enumerate(plan) if "functions=[bitmap_construct_agg" in line)
    partial = next(i for i, line in enumerate(plan) if "functions=[partial_bitmap_construct_agg" in line)
    assert not [line for line in plan[final:partial] if "Exchange" in line]


def _counts(rows):
    by = rows.groupBy("status").agg(F.count_distinct("who").alias("c")).collect()
    return {(r.status, r.c) for r in by} | {(None, rows.select("who").distinct().count())}

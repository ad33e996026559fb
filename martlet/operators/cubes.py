"""Cube with exact distinct counts of several ids, rolled up from one base of bitmaps.

The rows are read and grouped once, by all dimensions and by blocks of 32,768 ids, each block a bitmap. Every coarser level ORs
the bitmaps of the base; no level goes back to the rows, and a row is not repeated per level. Rows are first reduced map-side to each group's distinct ids, so a group of a
third of all rows, or an id of as many, is spread over tasks; blocks are then made whole in one task each, so bitmaps are not made once per task. A bitmap takes 4 KB whatever it holds, so this suits ids that lie close together (keys that a database
numbered); scattered ids are still counted exactly, at more memory per id.

Defined cases: a null id is not counted; a null dimension is a value of its own, told from "all" by ``level`` (one bit per dimension, the first the
highest, set where it is rolled up); sums over nulls alone are null; no rows give no rows, as Spark's grouping sets do.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sales_cube(rows: DataFrame, dimensions: list[str], ids: dict[str, str], sums: dict[str, str]) -> DataFrame:
    """(dimensions, level, row_count, a distinct count per ``ids`` {integer column: name}, a total per ``sums`` {column: name}) of every subset of dimensions."""
    named = [f"d{k}" for k in range(len(dimensions))]
    dims = [F.col(c).alias(n) for c, n in zip(dimensions, named, strict=True)]
    sets = [list(s) for size in range(len(named) + 1) for s in combinations(named, size)]
    level = F.lit(0)
    for n in named:
        level = level * 2 + F.grouping(n)
    level = level.cast("long").alias("level")

    def rolled(base: DataFrame, extra: list[str], figures: list[Column]) -> DataFrame:
        wanted = [[F.col(c) for c in [*s, *extra]] for s in sets]
        return base.groupingSets(wanted, *named, *extra).agg(level, *figures)

    totals = rows.groupBy(*dims).agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(f"s{k}") for k, c in enumerate(sums)])
    table = rolled(totals, [], [F.sum("n").alias("row_count"), *[F.sum(f"s{k}").alias(f"s{k}") for k in range(len(sums))]])
    if ids:
        # one row per id column: all of them share the grouping
        each = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).cast("bigint").alias("id")) for k, c in enumerate(ids)]))
        held = rows.select(*dims, each.alias("x")).filter("x.id IS NOT NULL").select(*named, "x.kind", "x.id")
        # each (group, id) once, then a block's rows in one task: no task makes bitmaps of its own for blocks that others hold too, so
        # there are as many bitmaps as groups and blocks, however many tasks read the rows; a block has at most 32,768 ids per group
        blocked = held.distinct().select("*", F.bitmap_bucket_number("id").alias("block")).repartition("kind", "block")
        base = blocked.withColumn("bit", F.bitmap_bit_position("id")).groupBy(*named, "kind", "block").agg(F.bitmap_construct_agg("bit").alias("bits"))
        merged = rolled(base, ["kind", "block"], [F.bitmap_count(F.bitmap_or_agg("bits")).alias("c")])
        counted = merged.groupBy(*named, "level").agg(*[F.sum(F.when(F.col("kind") == k, F.col("c"))).alias(f"c{k}") for k in range(len(ids))])
        other = counted.toDF(*[f"of_{c}" if c in (*named, "level") else c for c in counted.columns])
        same = F.col("level") == F.col("of_level")
        for n in named:
            same = same & F.col(n).eqNullSafe(F.col(f"of_{n}"))
        table = table.join(other, same, "left")
    return table.select(*[F.col(n).alias(c) for n, c in zip(named, dimensions, strict=True)], "level", "row_count",
                        *[F.coalesce(f"c{k}", F.lit(0)).cast("long").alias(name) for k, name in enumerate(ids.values())],
                        *[F.col(f"s{k}").alias(name) for k, name in enumerate(sums.values())])

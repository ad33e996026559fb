"""Top k of every group, ties included or broken by further columns.

Each task first keeps the k best rows of every group it holds (the window-group limit that Spark places before the exchange for a
``row_number`` or ``rank`` bound), in groups of (group, slice); a second limit then takes the k best of the slices. A slice is a hash of the row's task, so
a group that every one of many thousand tasks has rows of is merged by ``SLICES`` tasks first, and no task ever sorts a whole group.

Defined cases: nulls in an ordering column come last; a null group is a group like any other; with ``ties`` all rows alike in the ordering columns to the k-th stay, however
many (they are the result's own rows); without it the ordering should be total, else which of alike rows stays is open; k under 1 raises; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SLICES = 64


def top_k(rows: DataFrame, groups: list[str], best: dict[str, bool], k: int, *, ties: bool = False, rank: str = "rank") -> DataFrame:
    """The k best ``rows`` of each group by the columns ``best`` (True: greatest first), with their place ``rank`` from 1."""
    if k < 1 or not best:
        raise ValueError("top_k needs k of 1 or more and an ordering")
    if rank.lower() in {c.lower() for c in rows.columns}:
        raise ValueError(f"{rank} is a column of the rows already")
    order = [F.col(f"own.{c}").desc_nulls_last() if down else F.col(f"own.{c}").asc_nulls_last() for c, down in best.items()]
    place = F.rank() if ties else F.row_number()
    packed = rows.select(F.struct(*[F.col(c) for c in groups]).alias("g"), F.struct(*[F.col(c) for c in rows.columns]).alias("own"),
                         F.pmod(F.hash(F.spark_partition_id()), F.lit(SLICES)).alias("slice"))
    sliced = packed.withColumn("place", place.over(Window.partitionBy("g", "slice").orderBy(*order))).filter(F.col("place") <= k)
    merged = sliced.withColumn("place", place.over(Window.partitionBy("g").orderBy(*order))).filter(F.col("place") <= k)
    return merged.select("own.*", F.col("place").alias(rank))

"""As-of and interval join: each row with the version of its key that was valid at the row's instant.

Rows and versions are dealt together by ranges of (key, instant), so a key with a third of all rows spreads over many tasks. Within a range a
running maximum carries the latest version on; what a range hands on concerns only the key that goes on across its border, so the broadcast
table has at most one row per range. No row meets more than one version, and nothing is compared in pairs.

Defined cases: a version counts from its instant on, that instant included; of versions of one key and instant the greatest in its other values counts; a
version with an end does not count from that end on, and an older version does not come back; versions without key or instant never
count; rows without key or instant, or before the first version, have nulls; repeated rows are kept; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlet.operators.sessions import _handed_on, _stitch, _written


def as_of_join(rows: DataFrame, versions: DataFrame, *, key: str, instant: str, version_key: str, valid_from: str, values: dict[str, str],
               valid_to: str | None = None) -> DataFrame:
    """``rows`` with the columns ``values`` (version column: name in the result) of the version valid at ``instant``."""
    taken = [*rows.columns, *values.values()]
    if len({c.lower() for c in taken}) < len(taken):
        raise ValueError(f"names occur twice: {taken}")
    kind = rows.select(F.col(key)).schema[0].dataType
    packed = rows.select(F.col(key).alias("k"), F.col(instant).alias("at"), F.struct(*[F.col(c) for c in rows.columns]).alias("own"))
    until = F.col(valid_to) if valid_to else F.lit(None).cast("timestamp_ntz")
    version = F.struct(F.col(valid_from).alias("since"), until.alias("until"), F.struct(*[F.col(c).alias(n) for c, n in values.items()]).alias("found"))
    offered = (versions.filter(F.col(version_key).isNotNull() & F.col(valid_from).isNotNull())
               .select(F.col(version_key).cast(kind).alias("k"), F.col(valid_from).alias("at"), version.alias("version")))
    placed = packed.filter(F.col("k").isNotNull() & F.col("at").isNotNull())
    # a version comes before the rows of its instant; the number tells apart rows that are alike, so they can lie in several ranges
    merged = (offered.withColumn("is_row", F.lit(False)).unionByName(placed.withColumn("is_row", F.lit(True)), allowMissingColumns=True)
              .withColumn("number", F.monotonically_increasing_id()))
    dealt = _written(merged.repartitionByRange("k", "at", "is_row", "number").withColumn("part", F.spark_partition_id()).drop("number"), "as-of")
    edges = dealt.groupBy("part", "k").agg(F.max("version").alias("latest"))
    handed = _handed_on(edges, "k", before=F.max("latest"))
    so_far = (Window.partitionBy("part", "k").orderBy("at", "is_row").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    scanned = dealt.withColumn("latest", F.max("version").over(so_far)).filter("is_row").drop("version")
    joined = _stitch(scanned, handed, "k").withColumn("version", F.greatest("latest", "before"))
    valid = F.col("version.until").isNull() | (F.col("at") < F.col("version.until"))
    found = joined.select("own.*", *[F.when(valid, F.col("version.found")[n]).alias(n) for n in values.values()])
    unplaced = rows.filter(F.col(key).isNull() | F.col(instant).isNull())
    return found.unionByName(unplaced.select("*", *[F.lit(None).cast(found.schema[n].dataType).alias(n) for n in values.values()]))

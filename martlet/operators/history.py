"""Slowly changing history (type 2) of a table that arrives as full snapshots, one per batch.

Each version of a key holds from the batch that first showed it until the batch that showed another, or no longer the key. ``next_history`` compares the
open versions with a snapshot by one full outer join on the key (both sides unique, so no key is hot) and yields the whole
next history; ``apply_snapshot`` keeps it as versioned Parquet, closed versions and open ones apart, so that a batch rewrites only the open ones and
adds the versions it closes. Applying a batch again adds nothing; an older batch than the last is refused.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.functions.batch_ids import require_batch_id
from martlet.sources import versions

PERIOD = "valid_from timestamp_ntz, valid_to timestamp_ntz, from_batch string, to_batch string"


def _checked(snapshot: DataFrame, key: str) -> DataFrame:
    """The snapshot, if every key is there once and none is null."""
    bad = snapshot.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col(key).isNull() | (F.col("n") > 1)).take(1)
    if bad:
        raise ValueError(f"a snapshot has one row per {key}, and none without; found {bad[0]['n']} of {bad[0][key]}")
    return snapshot


def changes(opened: DataFrame, snapshot: DataFrame, key: str, batch_id: str, instant: Column) -> DataFrame:
    """Versions after a snapshot: open ones that stay, those it closes, and those it opens.

    Values are compared null-safe, column by column. ``opened`` has the snapshot's columns and the period's.
    """
    values = [c for c in snapshot.columns if c != key]
    one, two = opened.alias("o"), snapshot.alias("s")
    both = one.join(two, F.col(f"o.{key}") == F.col(f"s.{key}"), "full_outer")
    here, there = F.col(f"o.{key}").isNotNull(), F.col(f"s.{key}").isNotNull()
    same = here & there
    for c in values:
        same = same & F.col(f"o.{c}").eqNullSafe(F.col(f"s.{c}"))
    batch = F.lit(batch_id)

    def version(side: str, start: Column, end: Column, first: Column, last: Column) -> Column:
        return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in snapshot.columns], start.alias("valid_from"), end.cast("timestamp_ntz").alias("valid_to"),
                        first.alias("from_batch"), last.cast("string").alias("to_batch"))

    none = F.lit(None)
    old = F.when(here, version("o", F.col("o.valid_from"), F.when(~same, instant), F.col("o.from_batch"), F.when(~same, batch)))
    new = F.when(there & ~same, version("s", instant, none, batch, none))
    return both.select(F.inline(F.array_compact(F.array(old, new))))


def next_history(history: DataFrame | None, snapshot: DataFrame, key: str, batch_id: str, instant: Column) -> DataFrame:
    """The whole history after one more snapshot (``history`` None: the first)."""
    require_batch_id(batch_id)
    _checked(snapshot, key)
    if history is None:
        spark = snapshot.sparkSession
        none = spark.createDataFrame([], snapshot.schema).select("*", *[F.lit(None).cast(k).alias(c) for c, k in (p.split() for p in PERIOD.split(", "))])
        return changes(none, snapshot, key, batch_id, instant)
    open_ = F.col("valid_to").isNull()
    return history.filter(~open_).unionByName(changes(history.filter(open_), snapshot, key, batch_id, instant))


def read_history(spark: SparkSession, root: str) -> DataFrame | None:
    """All versions, or None before the first batch."""
    _, state = versions.current(spark, root)
    if not state:
        return None
    return spark.read.parquet(*state["closed"], state["open"])


def apply_snapshot(snapshot: DataFrame, root: str, key: str, batch_id: str, instant: Column) -> DataFrame:
    """Bring the history kept at ``root`` up to a batch and return it; a batch that was applied changes nothing.

    One folder of closed versions is added per batch that closes any, the open ones are written anew, and one pointer makes both current.
    """
    spark = snapshot.sparkSession
    require_batch_id(batch_id)
    number, state = versions.current(spark, root)
    applied = state.get("batches", [])
    if batch_id in applied:
        return read_history(spark, root)
    if applied and batch_id < applied[-1]:
        raise ValueError(f"batch {batch_id} is older than {applied[-1]}, which has been applied")
    opened = spark.read.parquet(state["open"]) if state else None
    after = next_history(opened, snapshot, key, batch_id, instant)
    folder = versions.new_folder(root, "versions")
    # one pass writes both kinds; a reader sees neither before the pointer names them
    after.withColumn("is_open", F.col("valid_to").isNull()).write.partitionBy("is_open").parquet(folder)
    open_part, closed_part = f"{folder}/is_open=true", f"{folder}/is_open=false"
    if not versions.exists(spark, open_part):  # every key has gone: an empty table keeps the columns
        after.limit(0).write.parquet(open_part)
    closed = [*state.get("closed", []), *([closed_part] if versions.exists(spark, closed_part) else [])]
    versions.publish(spark, root, {"batches": [*applied, batch_id], "closed": closed, "open": open_part}, number)
    return read_history(spark, root)


def as_of(history: DataFrame, instant: Column) -> DataFrame:
    """The versions that held at an instant."""
    return history.filter((F.col("valid_from") <= instant) & (F.col("valid_to").isNull() | (F.col("valid_to") > instant)))

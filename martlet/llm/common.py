"""Small helpers the operators share: batches, names, shared-folder tables, hot keys, components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.session import SHUFFLES_GO, configure, remove_folder, work_dir

#: ASCII white space of the word rules: space and \t \n \v \f \r.
SPACE = r"\x20\x09-\x0D"
#: A-Z to a-z, every other byte unchanged.
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    """A-Z to a-z, leaving every other code point alone."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(col: Column) -> Column:
    """The maximal runs of non-space characters, in order (null text: none)."""
    return F.array_remove(F.split(F.coalesce(col, F.lit("")), f"[{SPACE}]+"), "")


def free_names(taken: list[str], *wanted: str) -> list[str]:
    """Column names that clash with none of ``taken``, whatever their case."""
    lower, out = {t.lower() for t in taken}, []
    for name in wanted:
        while name.lower() in lower:
            name += "_"
        lower.add(name.lower())
        out.append(name)
    return out


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut into pieces of at most ``rows`` rows, which bounds what Python objects hold."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def as_bytes(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A string or binary column as bytes objects (no UTF-8 decoding)."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.large_binary()).to_pylist()


_TEMPORARY: ContextVar[tuple[list[str], ...]] = ContextVar("temporary", default=())


@contextmanager
def temporary(spark: SparkSession):
    """Tables that ``written`` makes in this block are removed at its end, but for those it makes for ``outer`` use."""
    stack = (*_TEMPORARY.get(), [])
    token = _TEMPORARY.set(stack)
    try:
        yield
    finally:
        _TEMPORARY.reset(token)
        for path in stack[-1]:
            remove_folder(spark, path)


def written(df: DataFrame, purpose: str, compression: str = "snappy", outer: bool = False) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage, survives lost executors; see ``temporary`` for when it goes."""
    return _stored(df, purpose, compression, outer)[0]


def _stored(df: DataFrame, purpose: str, compression: str = "snappy", outer: bool = False) -> tuple[DataFrame, str]:
    spark, path = df.sparkSession, work_dir(df.sparkSession, purpose)
    configure(spark, SHUFFLES_GO)
    blocks = _TEMPORARY.get()[:-1] if outer else _TEMPORARY.get()
    if blocks:
        blocks[-1].append(path)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def join_counted(left: DataFrame, right: DataFrame, keys: list[str], count: str, total: int,
                 how: str = "left", share: int = 1000) -> DataFrame:
    """``left`` joined to the unique-keyed ``right`` when some keys are very frequent in ``left``.

    ``right[count]`` says how many rows of ``left`` carry each key and ``total``
    how many rows ``left`` has. Keys with more than ``total / share`` rows
    number fewer than ``share``, so that part of ``right`` is broadcast (its size
    is bounded whatever the data); every other key holds at most ``1 / share`` of
    the rows and takes an ordinary shuffled join. Rows resolved by the broadcast carry a
    row-wise salt through that join, so a hot key is spread over all partitions. ``left`` is computed once.
    """
    if how not in ("left", "inner"):
        raise ValueError(how)
    hot_min = max(total // share, 1)
    payload = [c for c in right.columns if c not in keys]
    salt, hot, cold = free_names([*left.columns, *right.columns], "salt", "hot_value", "cold_value")
    packed = F.struct(F.lit(True).alias("found"), *payload)
    frequent = F.broadcast(right.filter(F.col(count) > hot_min).select(*keys, packed.alias(hot)))
    others = right.filter(F.col(count) <= hot_min).select(*keys, F.lit(0).cast("bigint").alias(salt), packed.alias(cold))
    tagged = left.join(frequent, keys, "left").withColumn(
        salt, F.when(F.col(hot).isNull(), F.lit(0)).otherwise(F.monotonically_increasing_id() + 1).cast("bigint"))
    value = F.coalesce(F.col(hot), F.col(cold))
    joined = tagged.join(others, [*keys, salt], "left")
    if how == "inner":
        joined = joined.filter(F.col(hot).isNotNull() | F.col(cold).isNotNull())
    return joined.select(*left.columns, *[value[c].alias(c) for c in payload])


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of an edge list; component = smallest node reachable.

    Large-star and small-star rounds (each a grouped minimum and a join) until
    the edge list no longer changes. Every node of a group ends up pointing at
    its smallest member. The rounds are written to the shared folder, so a lost
    executor re-reads a table instead of replaying the rounds. Minimum-first
    grouping is map-side combined, a round's table goes when the next is written, and the joins leave a hot centre to AQE's skew splitting.
    Self loops and repeated edges are allowed; nulls are ignored.
    """
    e = (edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
         .filter("u IS NOT NULL AND v IS NOT NULL")
         .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    e, path = _stored(e, "components")
    state = None
    for _ in range(max_rounds):
        # large star: every larger neighbour points at the smallest of the neighbourhood
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(e.filter("u = v")).distinct())
        # small star: every smaller neighbour, and the node itself, points at the smallest
        down = large.filter("u > v")
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (down.join(low, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v")))
                 .unionByName(large.filter("u = v")).distinct())
        before = path
        e, path = _stored(small, "components")
        remove_folder(edges.sparkSession, before)
        new = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == state:
            break
        state = new
    else:
        raise RuntimeError("components did not settle")
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")))
            .groupBy("node").agg(F.min("component").alias("component")))

"""Conversation prefix trie: every distinct sequence of first turns, aggregated by ROLLUP over positional turn-id columns.

A conversation becomes one row per block of ``WIDTH`` positions: the node before the block (``prior``, a 128-bit hash of all earlier turns), and
the ids of the block's turns as columns t1, t2, .... ``GROUP BY block, prior, ROLLUP (t1, ..., tW)`` then gives every prefix that
ends in the block, and ``grouping_id`` its depth. A longer conversation goes on in a further block keyed by the prior block's last node, which
is known beforehand, so all blocks are rolled up together whatever the longest conversation.

Sums over subtrees need no walk of the tree. A node belongs to its smallest member; the nodes of one conversation are then the last of its path. A second
rollup adds up, per node, what its members have at their own nodes (a leaf or none, code points), from which the node's leaves and
``saved_tokens`` follow.

Hot groups: positions in a conversation come from a range-partitioned sort (a conversation of any length is spread over tasks),
sums along a conversation run within chunks of ``CHUNK`` blocks and then over chunks, aggregates are combined map-side, a node with very many children
is joined by ``join_counted``, and the ids of conversations that end at one node are joined to strings in sorted pieces before one
task hashes the pieces in order, a batch at a time.

Turns are the same if role and text are (an MD5 of both, 128 bits). Defined cases: rows without a conversation id are not part of any; null role and text are empty; null turns come first, and
ties in turn go by the MD5 of role and text (repeated rows are turns of their own); without any conversation there is no node, not even the root; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.llm.common import join_counted, written

#: Positions in a block.
WIDTH = 8
#: Blocks of a conversation that meet in one window.
CHUNK = 4096
#: Joined ids sent on at once, in bytes.
PIECE = 1 << 16


def turn_table(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(c, turn, digest, chars) of every turn of a conversation."""
    who, said = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    return turns.filter(F.col(conversation).isNotNull()).select(
        F.col(conversation).cast("bigint").alias("c"), F.col(turn).alias("turn"),
        F.md5(F.concat(F.char_length(who).cast("string"), F.lit(" "), who, said)).alias("digest"),
        F.char_length(said).cast("bigint").alias("chars"))


def local_positions(turns: DataFrame) -> DataFrame:
    """(c, at, digest, chars, part): turns in order, counted from 1 within each range partition ``part``; a table.

    The sort is by ranges of (conversation, turn, digest, row), so that even one conversation, or one repeated row, spreads over tasks.
    """
    order = ["c", F.col("turn").asc_nulls_first(), "digest", "row"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, count = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            c = batch.column(0).to_numpy()
            starts = np.flatnonzero(np.concatenate(([True], c[1:] != c[:-1])))
            at = np.arange(1, len(c) + 1) - np.repeat(starts, np.diff(np.append(starts, len(c))))
            if c[0] == last:
                at[:starts[1] if len(starts) > 1 else len(c)] += count
            last, count = c[-1], int(at[-1])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(at.astype(np.int64)), batch.column(1), batch.column(2)],
                                             names=["c", "at", "digest", "chars"])

    dealt = (turns.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
             .select("c", "digest", "chars").mapInArrow(run, "c bigint, at bigint, digest string, chars bigint"))
    return written(dealt.withColumn("part", F.spark_partition_id()), "turn-places")


def positions(turns: DataFrame) -> DataFrame:
    """(c, at, digest, chars): ``at`` counts a conversation's turns from 1.

    A conversation that goes on from the partition before is moved on by the turns it had there: one row per partition at most.
    """
    local = local_positions(turns)
    ends = local.groupBy("c", "part").agg(F.max("at").alias("n"))
    before = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    moved = ends.withColumn("before", F.sum("n").over(before)).filter("before IS NOT NULL").select("c", "part", "before")
    return (local.join(F.broadcast(moved), ["c", "part"], "left")
            .select("c", (F.col("at") + F.coalesce("before", F.lit(0))).alias("at"), "digest", "chars"))


def share_openings(placed: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """Rebuilt conversations (c, at, digest, chars), null ``at`` for a turnless one; a table.

    Conversation c starts with the first h turns of conversation ``c - c % every`` (h = crc32(decimal c) % ``most``), then come its
    own turns after its first h.
    """
    opening = F.crc32(F.col("c").cast("string").cast("binary")) % most
    sizes = (placed.groupBy("c").agg(F.count(F.lit(1)).alias("n")).withColumn("h", opening)
             .withColumn("base", F.col("c") - F.col("c") % every))
    first = placed.filter((F.col("c") % every == 0) & (F.col("at") < most))
    bases = first.groupBy(F.col("c").alias("base")).agg(F.count(F.lit(1)).alias("has"))
    planned = written(sizes.join(bases, "base", "left")
                      .withColumn("shared", F.least("h", F.coalesce("has", F.lit(0)))).drop("has"), "conversations")
    shared = (planned.join(first.select(F.col("c").alias("base"), "at", "digest", "chars"), "base")
              .filter("at <= shared").select("c", "at", "digest", "chars"))
    total = planned.agg(F.sum("n")).first()[0] or 0
    own = (join_counted(placed, planned.select("c", "n", "h", "shared"), ["c"], "n", total, how="inner").filter("at > h")
           .select("c", (F.col("at") - F.col("h") + F.col("shared")).alias("at"), "digest", "chars"))
    turnless = planned.filter("shared = 0 AND n <= h").select(
        "c", F.lit(None).cast("bigint").alias("at"), F.lit(None).cast("string").alias("digest"), F.lit(0).cast("bigint").alias("chars"))
    return written(shared.unionByName(own).unionByName(turnless), "rebuilt-turns")


def _slots(width: int) -> list[str]:
    return [f"t{j}" for j in range(1, width + 1)]


def _halves() -> list[Column]:
    """Two 64-bit hashes of (position, turn) as four numbers of 32 bits, whose sums stay exact."""
    out = []
    for seed in range(2):
        h = F.xxhash64(F.lit(seed), F.col("at"), F.col("digest"))
        out += [F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint"))]
    return [F.when(F.col("at").isNull(), F.lit(0).cast("bigint")).otherwise(x) for x in out]


def blocks(turns: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per conversation and block: c, block, prior, after (hashes of the turns before it and up to its end), past (code points before it), size, t1, ..., tW; a table.

    A turn-id column holds the turn's digest and its code points, so that a node knows the length of its last text.
    """
    slot, name = F.pmod(F.col("at") - 1, F.lit(width)), F.concat_ws(":", "digest", "chars")
    sums = ["a1", "a2", "a3", "a4"]
    rows = (turns.withColumn("block", F.coalesce(F.floor((F.col("at") - 1) / width), F.lit(0))).groupBy("c", "block").agg(
        F.sum("chars").alias("size"), F.count("at").alias("held"), *[F.sum(x).alias(a) for a, x in zip(sums, _halves(), strict=True)],
        *[F.max(F.when(slot == j, name)).alias(t) for j, t in enumerate(_slots(width))]))
    rows = written(rows.withColumn("chunk", F.floor(F.col("block") / CHUNK)), "turn-blocks")
    running = ["size", *sums]
    within = Window.partitionBy("c", "chunk").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("c").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = (rows.groupBy("c", "chunk").agg(*[F.sum(x).alias(x) for x in running])
              .select("c", "chunk", *[F.sum(x).over(earlier).alias(f"{x}_before") for x in running]).filter("size_before IS NOT NULL"))
    along = rows.select("*", *[F.sum(x).over(within).alias(f"{x}_in") for x in running]).join(chunks, ["c", "chunk"], "left")
    upto = {x: F.col(f"{x}_in") + F.coalesce(f"{x}_before", F.lit(0)) for x in running}
    return written(along.select(
        "c", "block", F.md5(F.concat_ws(",", *[upto[a] - F.col(a) for a in sums])).alias("prior"),
        F.md5(F.concat_ws(",", *[upto[a] for a in sums])).alias("after"), (upto["size"] - F.col("size")).alias("past"),
        "size", "held", *_slots(width)), "turn-blocks")


def _prefix(level: Column, width: int) -> Column:
    """The node after ``level`` turns of a block."""
    inside = F.md5(F.concat_ws("|", F.col("block").cast("string"), "prior", F.slice(F.array(*_slots(width)), F.lit(1), level)))
    return F.when(level == 0, F.col("prior")).when(level == width, F.col("after")).otherwise(inside)


def _rolled(rows: DataFrame, measures: str, width: int = WIDTH) -> DataFrame:
    """The measures of every node, with node, parent, depth and the code points of its last text (chars) and of those before it (past)."""
    found = rows.sparkSession.sql(f"""
        SELECT block, prior, {", ".join(_slots(width))}, {width} - bit_count(grouping_id()) AS level,
               any_value(after) AS after, any_value(past) AS before_block, {measures}
        FROM {{rows}} GROUP BY block, prior, ROLLUP ({", ".join(_slots(width))})""", rows=rows)
    ids = F.array(*_slots(width))
    # a level without a turn is no node; level 0 is the node that ends the block before, but for the root
    real = found.filter(((F.col("level") == 0) & (F.col("block") == 0)) | F.get(ids, F.col("level") - 1).isNotNull())
    length = lambda t: F.split_part(t, F.lit(":"), F.lit(2)).cast("bigint")
    above = F.aggregate(F.slice(ids, F.lit(1), F.greatest(F.col("level") - 1, F.lit(0))), F.lit(0).cast("bigint"), lambda s, t: s + length(t))
    drop = {"block", "prior", "level", "after", "before_block", *_slots(width)}
    return real.select(
        _prefix(F.col("level"), width).alias("node"),
        F.when(F.col("level") > 0, _prefix(F.col("level") - 1, width)).alias("parent"),
        (F.col("block") * width + F.col("level")).cast("bigint").alias("depth"),
        F.when(F.col("level") == 0, 0).otherwise(length(F.get(ids, F.col("level") - 1))).cast("bigint").alias("chars"),
        (F.col("before_block") + above).alias("past"), *[c for c in found.columns if c not in drop])


def end_digests(rows: DataFrame, width: int = WIDTH) -> DataFrame:
    """(node, ends_sha256) of the nodes where a conversation ends.

    Decimal ids are joined in sorted order within range partitions, in pieces; the pieces of a node are then hashed in order, batch by batch, so no
    list of a node's conversations is ever held.
    """
    ends = (rows.groupBy("c").agg(F.max(F.struct("block", "prior", "after", "held", *_slots(width))).alias("e")).select("c", "e.*")
            .select(_prefix(F.col("held").cast("int"), width).alias("node"), "c"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, start, ids, size = None, None, [], 0
        out: list[tuple] = []

        def close():
            if ids:
                out.append((node, start, ",".join(ids)))

        for batch in batches:
            for n, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if n != node or size >= PIECE:
                    close()
                    node, start, ids, size = n, c, [], 0
                ids.append(str(c))
                size += len(ids[-1]) + 1
            yield _batch(out, ["node", "start", "ids"])
            out.clear()
        close()
        yield _batch(out, ["node", "start", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        out: list[tuple] = []
        for batch in batches:
            for n, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if n != node:
                    if node is not None:
                        out.append((node, state.hexdigest()))
                    node, state = n, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _batch(out, ["node", "ends_sha256"])
            out.clear()
        if node is not None:
            yield _batch([(node, state.hexdigest())], ["node", "ends_sha256"])

    pieces = (ends.repartitionByRange("node", "c").sortWithinPartitions("node", "c")
              .mapInArrow(join, "node string, start bigint, ids string"))
    return (pieces.repartition("node").sortWithinPartitions("node", "start").select("node", "ids")
            .mapInArrow(digest, "node string, ends_sha256 string"))


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = {"start": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds.get(n, pa.string())) for i, n in enumerate(names)], names=names)


def build_trie(turns: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per node of the rebuilt conversations (c, at, digest, chars): its figures, its parent's smallest member and its ends' digest."""
    rows = blocks(turns, width)
    nodes = written(_rolled(rows, "min(c) AS c, count(*) AS members", width), "trie-nodes")
    families = nodes.filter("parent IS NOT NULL").groupBy("parent").agg(F.count(F.lit(1)).alias("n_children"))
    parents = written(nodes.join(families.withColumnRenamed("parent", "node"), "node", "left")
                      .withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie-nodes")
    # what a conversation has at the nodes of which it is the smallest member
    own = parents.groupBy("c").agg(F.sum("chars").alias("own"), F.max(F.struct("depth", (F.col("n_children") == 0).cast("bigint").alias("leaf"))).alias("e"))
    total = rows.groupBy("c").agg(F.sum("size").alias("total"), F.count(F.lit(1)).alias("rows"))
    constants = written(total.join(own, "c", "left").select(
        "c", "rows", (F.col("total") - F.coalesce("own", F.lit(0))).alias("shared"), F.coalesce("e.leaf", F.lit(0)).alias("leaf")), "trie-shares")
    known = join_counted(rows, constants, ["c"], "rows", rows.count(), how="inner")
    figures = _rolled(known, "count(*) AS n_convs, sum(shared) AS all_shared, sum(leaf) AS n_leaves, min(struct(c, shared)) AS smallest", width)
    joined = (figures.join(parents.select("node", "n_children"), "node")
              .join(end_digests(rows, width), "node", "left"))
    above = parents.filter("n_children > 0").select(F.col("node").alias("parent"), F.col("c").alias("parent_conv_id"), "n_children")
    size = parents.count()
    placed = join_counted(joined.withColumnRenamed("n_children", "own_children"), above, ["parent"], "n_children", size)
    return placed.select(
        F.col("smallest.c").alias("conv_id"), "depth", "parent_conv_id", "n_convs", F.col("own_children").alias("n_children"), "n_leaves",
        (F.col("all_shared") - F.col("smallest.shared") - (F.col("n_convs") - 1) * F.col("past")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, *, every: int = 100, most: int = 6, width: int = WIDTH) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return build_trie(share_openings(positions(turn_table(conversations)), every, most), width)

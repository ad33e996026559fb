"""SimHash near-dedup with pivot distance tables.

A fingerprint has bit i where over half of the shingles' XXH64 values (seed 42) do. Shingles are ``shingle``
consecutive words joined by spaces, repeats included; a text with fewer words is one shingle; a text without words, or
a null one, has fingerprint zero and is linked like any other.

Links: distinct fingerprints within ``max_distance`` bits. Pairs come from block keys (``hamming``): in a key's group
each fingerprint has a table of Hamming distances to ``PIVOTS`` reference fingerprints; pairs whose tables differ by more
than ``max_distance`` in some coordinate are discarded (triangle inequality), the others are verified. Only edges of a spanning
forest leave a group, never all its pairs. Groups larger than ``TILE`` are cut into tiles that meet pair by pair in
different tasks. Exact copies share a fingerprint and cost one row beyond the first pass.

Defined cases: null and repeated doc ids are ordinary rows; a component whose ids are all null has a null id; no rows
give no rows; other input columns are ignored by ``near_duplicates`` and kept as they are by ``keep_first``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import LOWER, as_bytes, connected_components, free_names, join_counted, slices, written
from martlet.llm.hamming import block_masks, key_columns, signed

SEED = 42
TILE = 4096
#: Reference fingerprints: the first outputs of splitmix64 from zero.
PIVOTS = 16


def pivots(n: int = PIVOTS) -> np.ndarray:
    out, x, mask = [], 0, (1 << 64) - 1
    for _ in range(n):
        x = (x + 0x9E3779B97F4A7C15) & mask
        z = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & mask
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & mask
        out.append(z ^ (z >> 31))
    return np.array(out, np.uint64)


def simhash(text: bytes | None, shingle: int) -> int:
    found = (text or b"").translate(LOWER).split()
    if not found:
        return 0
    body = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(found))
    digest, votes, n = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(found) - k + 1
    for at in range(0, n, 1 << 16):
        a, b = starts[at:min(at + (1 << 16), n)].tolist(), ends[at + k - 1:min(at + (1 << 16), n) + k - 1].tolist()
        h = np.array([digest(body[s:e], SEED) for s, e in zip(a, b, strict=True)], "<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * votes > n, bitorder="little")
    return int.from_bytes(bits.tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, content, fp) of every row: a hash of the text, and the fingerprint's 64 bits as a signed long."""

    def run(batches):
        for batch in slices(batches):
            fps = [signed(simhash(t, shingle)) for t in as_bytes(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps, pa.int64())],
                                             names=["key", "content", "fp"])

    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.xxhash64(text).alias("content"),
                       F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, "key long, content long, fp long")


def _links(fps: np.ndarray, reference: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of positions, through the pivot table: each fingerprint against those after it in order of its first coordinate."""
    table = np.bitwise_count(fps[:, None] ^ reference[None, :]).astype(np.int8)
    order = np.argsort(table[:, 0], kind="stable")
    table, fps = table[order], fps[order]
    stop = np.searchsorted(table[:, 0], table[:, 0] + np.int8(distance), side="right")
    for i in range(len(fps)):
        near = np.arange(i + 1, stop[i])
        for c in range(1, table.shape[1]):
            if len(near) < 64:
                break
            near = near[np.abs(table[near, c] - table[i, c]) <= distance]
        if len(near):
            near = near[(np.abs(table[near] - table[i]) <= distance).all(axis=1)]
            near = near[np.bitwise_count(fps[near] ^ fps[i]) <= distance]
            if len(near):
                yield order[near], np.full(len(near), order[i])


def _forest(fps: np.ndarray, reference: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Spanning forest edges of one group."""
    label, edges = np.arange(len(fps)), []
    for near, own in _links(fps, reference, distance):
        i = own[0]
        fresh, first = np.unique(label[near], return_index=True)
        for lab, at in zip(fresh.tolist(), near[first].tolist(), strict=True):
            if lab != label[i]:
                edges.append((int(fps[i]), int(fps[at])))
                label[label == lab] = label[i]
    return edges


def _pairs_of_small(group: np.ndarray, fps: np.ndarray, reference: np.ndarray, distance: int) -> list[np.ndarray]:
    """Verified pairs inside short runs of equal ``group``, all runs at once, by offset."""
    out = []
    table = np.bitwise_count(fps[:, None] ^ reference[None, :]).astype(np.int8)
    for o in range(1, len(fps)):
        i = np.flatnonzero(group[o:] == group[:-o])
        if not len(i):
            break
        i = i[(np.abs(table[i + o] - table[i]) <= distance).all(axis=1)]
        i = i[np.bitwise_count(fps[i + o] ^ fps[i]) <= distance]
        out.append(np.stack([fps[i], fps[i + o]], axis=1))
    return out


def _edges_of_partition(distance: int, small: int = 32):
    """mapInArrow function over rows sorted by (mask, kept, tile): fp edges of each group."""

    def run(batches):
        reference = pivots()
        held = None

        def emit(mask, kept, tile, fp):
            new = np.flatnonzero((mask[1:] != mask[:-1]) | (kept[1:] != kept[:-1]) | (tile[1:] != tile[:-1])) + 1
            starts = np.concatenate(([0], new))
            sizes = np.diff(np.concatenate((starts, [len(fp)])))
            found = []
            group = np.repeat(np.arange(len(starts)), sizes)
            few = np.repeat((sizes > 1) & (sizes <= small), sizes)
            if few.any():
                found += _pairs_of_small(group[few], fp[few], reference, distance)
            for k in np.flatnonzero(sizes > small).tolist():
                forest = _forest(fp[starts[k]:starts[k] + sizes[k]], reference, distance)
                if forest:
                    found.append(np.array(forest, np.uint64))
            pairs = np.concatenate(found) if found else np.zeros((0, 2), np.uint64)
            a, b = (np.ascontiguousarray(pairs[:, c]).astype(np.uint64).view(np.int64) for c in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(4)]
            rows[3] = rows[3].view(np.uint64)
            if held is not None:
                rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
            last = np.flatnonzero((rows[0] != rows[0][-1]) | (rows[1] != rows[1][-1]) | (rows[2] != rows[2][-1]))
            cut = last[-1] + 1 if len(last) else 0  # the last group may go on in the next batch
            held = [x[cut:] for x in rows]
            if cut:
                yield emit(*(x[:cut] for x in rows))
        if held is not None:
            yield emit(*held)

    return run


def link_fingerprints(distinct: DataFrame, max_distance: int) -> DataFrame:
    """Edges (a, b) between the distinct fingerprints ``fp`` whose components are those of all links.

    A group of at most ``TILE`` fingerprints is one tile. A larger one is dealt by hash into ceil(n / TILE) parts and every pair
    of parts meets as a tile of its own, so no task holds more than about two parts.
    """
    masks = block_masks(distinct.count(), max_distance)
    keyed = distinct.select("fp", key_columns(F.col("fp"), masks).alias("key")).select("key.mask", "key.kept", "fp")
    large = written(keyed.groupBy("mask", "kept").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > TILE), "groups")
    total = large.agg(F.sum("n")).first()[0]
    if total:
        joined = join_counted(keyed, large, ["mask", "kept"], "n", total)
        parts = F.coalesce(F.ceil(F.col("n") / TILE), F.lit(1)).cast("int")
        tiles = (joined.withColumn("parts", parts)
                 .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
                 .withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
                 .select("mask", "kept", (F.least("part", "other") * 65536 + F.greatest("part", "other")).alias("tile"), "fp"))
    else:
        tiles = keyed.select("mask", "kept", F.lit(0).alias("tile"), "fp")
    grouped = tiles.repartition("mask", "kept", "tile").sortWithinPartitions("mask", "kept", "tile")
    return grouped.mapInArrow(_edges_of_partition(max_distance), "a long, b long").distinct()


def _with_components(docs: DataFrame, shingle: int, max_distance: int, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The (key, content, fp) table, and (fp, n, component, component_id) of the distinct fingerprints."""
    rows = written(fingerprints(docs, shingle, key, text), "fingerprints")
    distinct = written(rows.groupBy("fp").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("low")), "distinct")
    edges = written(link_fingerprints(distinct.select("fp"), max_distance), "links")
    if not edges.take(1):
        return rows, distinct.select("fp", "n", F.col("fp").alias("component"), F.col("low").alias("component_id"))
    member = connected_components(edges).withColumnRenamed("node", "fp")
    labelled = written(distinct.join(member, "fp", "left")
                       .withColumn("component", F.coalesce("component", "fp")), "labels")
    low = labelled.groupBy("component").agg(F.min("low").alias("component_id"))
    return rows, written(labelled.join(low, "component").select("fp", "n", "component", "component_id"), "classes")


def near_duplicates(docs: DataFrame, *, shingle: int = 4, max_distance: int = 4, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """Per row: key, fingerprint (16 hex digits), component_id (the smallest key of its component)."""
    rows, classes = _with_components(docs, shingle, max_distance, key, text)
    total = classes.agg(F.sum("n")).first()[0] or 0
    joined = join_counted(rows, classes, ["fp"], "n", total, how="inner")
    return joined.select(F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, *, shingle: int = 4, max_distance: int = 4, key: str = "doc_id",
               text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest key (null keys last), ties by content.

    Of rows that repeat both key and text, one stays.
    """
    rows, classes = _with_components(docs, shingle, max_distance, key, text)
    total = classes.agg(F.sum("n")).first()[0] or 0
    joined = join_counted(rows, classes, ["fp"], "n", total, how="inner")
    alike = joined.groupBy("component", "key", "content").agg(F.count(F.lit(1)).alias("alike"))
    first = alike.groupBy("component").agg(
        F.min(F.struct(F.col("key").isNull().alias("null_key"), "key", "content", "alike")).alias("first"))
    own, null_key, content, n = free_names(docs.columns, "own_key", "null_key", "content", "alike")
    kept = written(first.select(F.coalesce("first.key", F.lit(0)).alias(own), F.col("first.null_key").alias(null_key),
                                F.col("first.content").alias(content), F.col("first.alike").alias(n)), "kept")
    out = (docs.withColumn(own, F.coalesce(F.col(key).cast("bigint"), F.lit(0))).withColumn(null_key, F.col(key).isNull())
           .withColumn(content, F.xxhash64(text)).join(kept, [own, null_key, content]))
    once = out.filter(F.col(n) == 1).select(*docs.columns)
    again = out.filter(F.col(n) > 1).dropDuplicates([own, null_key, content]).select(*docs.columns)
    return once.unionByName(again)

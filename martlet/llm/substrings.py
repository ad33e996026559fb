"""Exact substring dedup with run-length suffix indexes.

Every byte covered by a ``length``-byte string that also starts anywhere else (same document included) is removed. Strings are judged on the
input texts as UTF-8 bytes and never cross documents.

A suffix index of a whole corpus fits no machine, so Spark first brings together what can match. The anchor of a window (``length`` bytes) is its
32-byte piece with the least hash, the rightmost of equals; equal windows have equal anchors. Consecutive windows of one anchor form a run; a run's context is the bytes its windows cover.

1. Anchors that occur twice or more are found by a grouped count of 64-bit hashes; a bitmap of fixed size lets later passes skip most others.
2. Runs with equal anchor and equal context are repeated as a whole.
3. Where an anchor has several contexts, one run per context is sent, by anchor, to a shard, which builds a run-length compressed
   Burrows-Wheeler transform of about ``INDEX_BYTES`` of contexts, with suffix positions and common prefix lengths sampled at run ends only, streams along the
   text carrying the matching length from sample to sample (it falls by one per byte in between), and marks starts that match ``length`` bytes or more.
4. An anchor with more than ``CROWD`` contexts (the edge of a passage that very many documents quote) is not sent to a shard: its windows are
   hashed one by one (128 bits) and counted by Spark. This is exact for any number.

Contexts are equal when two independent 64-bit values, the anchor's and the context's, agree.

Defined cases: null text is empty; texts shorter than ``length`` keep every byte; repeated rows are documents of their own, so a text of ``length`` bytes or more that is
repeated goes wholly; a null key is an ordinary row; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import as_bytes, join_counted, slices, written

PIECE = 32
CROWD = 5000
INDEX_BYTES = 512 << 10
_BITMAP_BITS = 26
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_ODD = np.uint64(0xBF58476D1CE4E5B9)


class _Powers:
    """Powers of the hash base and of its inverse, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> _Powers:
        while len(self.up) < n + 1:
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                old = getattr(self, name)
                setattr(self, name, np.concatenate([old, old * np.uint64(pow(base, len(old), 1 << 64))]))
        return self


_POWERS = _Powers()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _ODD
    return h ^ (h >> np.uint64(29))


class _Hasher:
    """Hashes of any substrings of one byte array."""

    def __init__(self, raw: np.ndarray):
        self.powers = _POWERS.upto(len(raw))
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.powers.down[:len(raw)], dtype=np.uint64)))

    def of(self, starts: np.ndarray, lengths) -> np.ndarray:
        return (self.sums[starts + lengths] - self.sums[starts]) * self.powers.up[starts]


def _window_minimum(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values."""
    n = len(h) - w + 1
    padded = np.concatenate((h, np.full(-len(h) % w, np.iinfo(np.uint64).max, np.uint64))).reshape(-1, w)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1:w - 1 + n])


def runs(body: bytes, length: int, contexts: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]:
    """Anchor, first window start, number of windows and context hash of each run of a text."""
    none = np.zeros(0, np.int64)
    if len(body) < length:
        return none, none, none, none
    hasher = _Hasher(np.frombuffer(body, np.uint8))
    at = np.arange(len(body) - PIECE + 1)
    h = _mixed((hasher.sums[PIECE:] - hasher.sums[:-PIECE]) * hasher.powers.up[:len(at)])
    w = length - PIECE + 1
    low = _window_minimum(h, w)
    fresh = h[w - 1:] == low  # an equal value that enters becomes the rightmost
    fresh[1:] |= low[1:] != low[:-1]
    fresh[0] = True
    starts = np.flatnonzero(fresh)
    sizes = np.diff(np.concatenate((starts, [len(low)])))
    anchors = low[starts].view(np.int64)
    if not contexts:
        return anchors, starts, sizes, None
    spans = sizes + length - 1
    whole = _mixed(hasher.of(starts, spans) ^ (spans.astype(np.uint64) * _ODD))
    return anchors, starts, sizes, whole.view(np.int64)


# -- the index of a shard ------------------------------------------------------------------------------------------

def _suffix_order(symbols: np.ndarray, longest: int) -> np.ndarray:
    """Suffix array by prefix doubling; symbols of ends are unique, so ``longest`` symbols decide."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    rank = np.zeros(n, np.int64)
    ranked = symbols[order]
    rank[order] = np.concatenate(([0], np.cumsum(ranked[1:] != ranked[:-1])))
    k = 1
    while k < longest and rank[order[-1]] < n - 1:
        second = np.zeros(n, np.int64)
        second[:n - k] = rank[k:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        rank[order] = np.concatenate(([0], np.cumsum(ranked[1:] != ranked[:-1])))
        k *= 2
    return order


def _common(hasher: _Hasher, a: np.ndarray, b: np.ndarray, most: int, n: int) -> np.ndarray:
    """Lengths of common prefixes of suffixes a and b, up to ``most``, by binary search on hashes."""
    low, high = np.zeros(len(a), np.int64), np.minimum(most, n - np.maximum(a, b))
    while (open_ := low < high).any():
        mid = (low + high + 1) // 2
        same = hasher.of(a, mid) == hasher.of(b, mid)
        low, high = np.where(open_ & same, mid, low), np.where(open_ & ~same, mid - 1, high)
    return low


def matching_lengths(segments: list[bytes]) -> np.ndarray:
    """For each byte of the joined segments (each followed by an end mark): how far the text from there also occurs elsewhere.

    The transform is compressed to its runs. Common prefixes with the suffix before are computed only where a run starts, those with the
    suffix after only where one ends; along the text either falls by exactly one where the transform's symbol repeats, so the
    samples' running maximum gives all of them.
    """
    longest = max(map(len, segments)) + 1
    sizes = np.array([len(s) + 1 for s in segments])
    n = int(sizes.sum())
    symbols = np.frombuffer(b"\0".join(segments) + b"\0", np.uint8).astype(np.int64) + len(segments)
    ends = np.cumsum(sizes) - 1
    symbols[ends] = np.arange(len(segments))
    order = _suffix_order(symbols, longest)
    transform = symbols[order - 1]  # the symbol before each suffix
    border = np.flatnonzero(transform[1:] != transform[:-1])  # the last row of a run; the next one starts another
    hasher = _Hasher(symbols)
    lengths = np.zeros(n, np.int64)
    place = np.arange(n)
    shared = _common(hasher, order[border], order[border + 1], longest, n)
    for sampled in (border + 1, border):
        reach = np.zeros(n, np.int64)
        np.maximum.at(reach, order[sampled], shared + order[sampled])
        lengths = np.maximum(lengths, np.maximum.accumulate(reach) - place)
    return lengths


def _index_shards(length: int):
    """mapInArrow function over contexts sorted by anchor: runs (k, null_key, c, s, m) of starts that match elsewhere."""

    def run(batches):
        held: list[tuple] = []
        size, last = 0, None

        def flush():
            if len(held) < 2:
                held.clear()
                return None
            lengths = matching_lengths([r[-1] for r in held])
            out, at = [], 0
            for k, null_key, c, s, m, body in held:
                hit = np.concatenate(([False], lengths[at:at + m] >= length, [False]))
                edges = np.flatnonzero(hit[1:] != hit[:-1]).reshape(-1, 2)
                out += [(k, null_key, c, s + int(a), int(b - a)) for a, b in edges]
                at += len(body) + 1
            held.clear()
            return _mark_batch(out)

        for batch in slices(batches, 2000):
            columns = [batch.column(i).to_pylist() for i in range(6)]
            for route, k, null_key, c, s, m, body in zip(*columns, as_bytes(batch, "body"), strict=True):
                if route != last and size > INDEX_BYTES:
                    done, size = flush(), 0
                    if done is not None:
                        yield done
                last = route
                held.append((k, null_key, c, s, m, body))
                size += len(body)
        done = flush()
        if done is not None:
            yield done

    return run


_MARKS = "k long, null_key boolean, c long, s int, m int"


def _mark_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 5
    kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["k", "null_key", "c", "s", "m"])


# -- the passes over the corpus --------------------------------------------------------------------------------------

def _bitmap(anchors: DataFrame) -> np.ndarray:
    """Bits of the anchors' leading ``_BITMAP_BITS`` bits: 2**20 words at most, whatever the number of anchors."""
    bit = F.shiftrightunsigned("a", 64 - _BITMAP_BITS)
    rows = (anchors.select(F.shiftright(bit, 6).alias("word"), F.expr("shiftleft(1L, cast(shiftrightunsigned(a, 38) & 63 as int))").alias("bits"))
            .groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow())
    out = np.zeros(1 << (_BITMAP_BITS - 6), np.uint64)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return out


def _in_bitmap(bits: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    at = anchors.view(np.uint64) >> np.uint64(64 - _BITMAP_BITS)
    return (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(key).cast("bigint"), F.lit(0)).alias("k"), F.col(key).isNull().alias("null_key"),
                       F.xxhash64(text).alias("c"), F.col(text).cast("binary").alias("body"))


def _equal_runs(found: DataFrame, groups: DataFrame, total: int) -> DataFrame:
    """The runs whose (a, x) occurs at least twice."""
    again = groups.filter("n > 1").select("a", "x", "n")
    return join_counted(found, again, ["a", "x"], "n", total, how="inner").select("k", "null_key", "c", "s", "m")


def repeated_starts(docs: DataFrame, key: str, text: str, length: int) -> DataFrame:
    """Runs (k, null_key, c, s, m): window starts s .. s + m - 1 of that document are repeated elsewhere."""
    if length < 2 * PIECE:
        raise ValueError(f"length must be {2 * PIECE} at least")
    spark, rows = docs.sparkSession, _rows(docs, key, text)

    def anchors_only(batches):
        for batch in slices(batches):
            found = [runs(b or b"", length, contexts=False)[0] for b in as_bytes(batch, "body")]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found))], names=["a"])

    twice = rows.select("body").mapInArrow(anchors_only, "a long").groupBy("a").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = spark.sparkContext.broadcast(_bitmap(twice))

    def with_context(batches):
        for batch in slices(batches):
            parts = []
            for i, body in enumerate(as_bytes(batch, "body")):
                a, s, m, x = runs(body or b"", length)
                keep = _in_bitmap(shared.value, a) if len(a) else np.zeros(0, bool)
                parts.append((a[keep], x[keep], s[keep], m[keep], np.full(int(keep.sum()), i)))
            a, x, s, m, i = (np.concatenate(p) for p in zip(*parts, strict=True))
            taken = [batch.column(c).take(pa.array(i)) for c in range(3)]
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(x), *taken, pa.array(s.astype(np.int32)), pa.array(m.astype(np.int32))],
                                             names=["a", "x", "k", "null_key", "c", "s", "m"])

    found = written(rows.mapInArrow(with_context, f"a long, x long, {_MARKS}"), "runs")
    groups = written(found.groupBy("a", "x").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("null_key", "k", "c", "s", "m")).alias("one")), "run-groups")
    total = found.count()
    whole = _equal_runs(found, groups, total)
    several = written(groups.groupBy("a").agg(F.count(F.lit(1)).alias("contexts")).filter("contexts > 1"), "several-contexts")
    wanted = (join_counted(groups.select("a", "one"), several, ["a"], "contexts", groups.count(), how="inner")
              .select("a", "contexts", "one.*"))
    by_document = wanted.groupBy("k", "null_key", "c").agg(F.collect_list(F.struct("a", "s", "m", (F.col("contexts") > CROWD).alias("crowd"))).alias("wanted"))
    joined = rows.join(by_document, ["k", "null_key", "c"])

    def cut(batches):
        """Contexts to send to shards; of crowded anchors the windows' hashes instead, without bytes."""
        for batch in slices(batches, 256):
            out = []
            lists = batch.column(batch.schema.get_field_index("wanted")).to_pylist()
            ids = [batch.column(c).to_pylist() for c in range(3)]
            for k, null_key, c, body, wanted in zip(*ids, as_bytes(batch, "body"), lists, strict=True):
                hasher = None
                for run in wanted:
                    s, m = run["s"], run["m"]
                    if not run["crowd"]:
                        out.append((run["a"], k, null_key, c, s, m, body[s:s + m + length - 1], None))
                        continue
                    hasher = hasher or _Hasher(np.frombuffer(body, np.uint8))
                    at = np.arange(s, s + m)
                    h = hasher.of(at, length)
                    other = [int.from_bytes(hashlib.blake2b(body[t:t + length], digest_size=8).digest(), "little", signed=True) for t in at.tolist()]
                    out += [(a, k, null_key, c, t, 1, None, x) for a, t, x in zip(_mixed(h).view(np.int64).tolist(), at.tolist(), other, strict=True)]
            columns = list(zip(*out, strict=True)) or [()] * 8
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, kinds, strict=True)],
                                             names=["a", "k", "null_key", "c", "s", "m", "body", "x"])

    pieces = joined.select("k", "null_key", "c", "body", "wanted").mapInArrow(cut, f"a long, {_MARKS}, body binary, x long")
    crowded = several.filter(F.col("contexts") > CROWD).take(1)
    if crowded:
        pieces = written(pieces, "contexts")
    shards = pieces.filter(F.col("body").isNotNull()).drop("x")
    marks = shards.repartition("a").sortWithinPartitions("a").mapInArrow(_index_shards(length), _MARKS)
    out = whole.unionByName(marks)
    if crowded:
        windows = pieces.filter(F.col("x").isNotNull()).select("a", "x", "k", "null_key", "c", "s", "m")
        again = written(windows.groupBy("a", "x").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "windows")
        out = out.unionByName(_equal_runs(windows, again, windows.count()))
    return out


def remove_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text", length: int = 200) -> DataFrame:
    """Per row: key, kept (the bytes that stay), n_bytes, n_removed, n_spans (maximal removed runs)."""
    marks = (repeated_starts(docs, key, text, length).groupBy("k", "null_key", "c")
             .agg(F.collect_set(F.struct("s", "m")).alias("marks")))
    joined = _rows(docs, key, text).join(marks, ["k", "null_key", "c"], "left").select("k", "null_key", "body", "marks")

    def cut(batches):
        for batch in slices(batches):
            out = []
            for k, null_key, body, marks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), as_bytes(batch, "body"),
                                                batch.column(3).to_pylist(), strict=True):
                body, kept, at, spans = body or b"", [], 0, 0
                for s, e in sorted((x["s"], x["s"] + x["m"] + length - 1) for x in marks or ()):
                    if s > at or not spans:
                        kept.append(body[at:s])
                        spans += 1
                    at = max(at, e)
                kept = b"".join([*kept, body[at:]])
                out.append((None if null_key else k, kept, len(body), len(body) - len(kept), spans))
            columns = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                                             names=["key", "kept", "n_bytes", "n_removed", "n_spans"])

    return joined.mapInArrow(cut, "key long, kept binary, n_bytes long, n_removed long, n_spans long").withColumnRenamed("key", key)


def repeat_report(docs: DataFrame, *, key: str = "doc_id", text: str = "text", length: int = 200) -> DataFrame:
    """Per row: key, n_bytes, n_removed, n_spans, kept_sha256."""
    out = remove_repeats(docs, key=key, text=text, length=length)
    return out.select(key, "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
